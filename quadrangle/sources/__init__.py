"""Scans of landed objects."""
