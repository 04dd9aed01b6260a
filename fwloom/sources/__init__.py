"""Readers: archives of fixed-width records, layout workbooks."""
