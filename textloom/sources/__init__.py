"""Scans, sinks and materialised indexes."""
