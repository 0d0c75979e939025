"""Audit, repair and compaction of height-numbered object archives on Spark."""
