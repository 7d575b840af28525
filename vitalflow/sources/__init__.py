"""Readers and writers: streams, CSV, archives, binary records, the points table."""
