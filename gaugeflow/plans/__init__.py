"""Queries over the star-schema tables, each next to its reference SQL."""
