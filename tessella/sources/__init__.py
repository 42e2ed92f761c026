"""Readers of native tables and files, and sinks."""
