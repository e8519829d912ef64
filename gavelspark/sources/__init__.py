"""Scans, archive tables and sinks."""
