"""Registered queries: fixtures derived from the given tables, Spark plans and reference SQL."""
