"""Streams: source audits, reporting windows and cross-run state."""
