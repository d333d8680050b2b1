"""Readers: files, lines, delimited rows, JSON records and streams."""
