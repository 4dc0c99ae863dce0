"""Scans and sinks: image files, managed tables, snapshots, weights."""
