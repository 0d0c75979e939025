"""Writers of batches, statistics, audit events and progress."""
