"""Scans, the adapter for the driver tables, and sinks."""
