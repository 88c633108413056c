"""Landed payloads to records, and records to files."""
