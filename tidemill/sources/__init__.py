"""Scans, sinks, frozen tables and published snapshots."""
