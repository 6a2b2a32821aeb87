"""Incident analytics on Spark: sources, column functions, operators and four reports."""
