"""Event stream ingest."""
