"""Scans, sinks and table snapshots."""
