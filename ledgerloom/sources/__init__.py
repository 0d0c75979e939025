"""Scans and row sources."""
