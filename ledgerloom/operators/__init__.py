"""Joins, aggregates and windows over heights, ranges and inventories."""
