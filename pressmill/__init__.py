"""Curation of large article corpora as Spark DataFrames."""
