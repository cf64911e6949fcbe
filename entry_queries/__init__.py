"""Queries over the test tables, each with its SQL for an independent engine."""
