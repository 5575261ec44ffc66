"""Scans and sinks: role catalog, week-partitioned mart, JSON exchange."""
