"""Queries and dataset specifications."""
