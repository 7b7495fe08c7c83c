"""Catalog analytics over Spark tables."""
