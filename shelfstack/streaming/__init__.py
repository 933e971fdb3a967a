"""Incremental file loads."""
