"""Readers and writers: raw feed, stored tables, staged intermediates, report files."""
