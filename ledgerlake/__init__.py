"""Curate append-only nested documents into typed, keyed and aggregated tables with PySpark."""
