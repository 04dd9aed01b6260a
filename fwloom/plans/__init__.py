"""Whole jobs: ingest, layout import, content-hash planning."""
