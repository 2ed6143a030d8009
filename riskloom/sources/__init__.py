"""Readers, writers, loads and the table registry."""
