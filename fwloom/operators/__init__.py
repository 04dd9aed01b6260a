"""Relational steps of an ingest, as DataFrame transformations."""
