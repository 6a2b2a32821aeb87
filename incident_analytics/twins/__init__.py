"""The operators and reports on the benchmark tables, each with a SQL twin."""
