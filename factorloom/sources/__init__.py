"""Readers and writers. Paths and options are parameters; nothing is configured elsewhere."""
