"""Sealing of batches as the head advances."""
