"""Scans, sinks and the shared scratch folder."""
