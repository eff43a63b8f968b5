"""Runnable queries over the given tables, and their twins in SQL."""
