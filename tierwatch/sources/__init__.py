"""Scans, typed ingest, sinks and inventories."""
