"""Readers and writers: tables, series pointers, grid files, serialised systems, results."""
