"""Readers: database tables, newline JSON and the bundled test tables."""
