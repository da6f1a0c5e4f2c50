"""Incremental ingest: an addition for landing folders that grow; batch runs need none of it."""
