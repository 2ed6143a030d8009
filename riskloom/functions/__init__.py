"""Column builders: no I/O, no actions."""
