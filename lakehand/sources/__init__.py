"""Readers: files by format, JDBC, landed pages and binaries, schema capture."""
