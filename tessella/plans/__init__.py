"""Queries, report tables and export documents."""
