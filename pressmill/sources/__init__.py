"""Readers for day caches, feeds and raw pages."""
