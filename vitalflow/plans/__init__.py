"""Registered queries, the tables they run on, and their SQL counterparts."""
