"""Registered queries and the composed run."""
