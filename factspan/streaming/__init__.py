"""Snapshots and exceptions as streams."""
