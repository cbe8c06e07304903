"""Readers and writers: report archives, delimited files, tables."""
