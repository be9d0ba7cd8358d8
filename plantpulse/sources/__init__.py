"""Readers and writers for topics, the lake, metric lines and CSV files."""
