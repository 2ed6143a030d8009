"""Jobs that chain operators over stored tables."""
