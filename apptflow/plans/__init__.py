"""Whole runs: the jobs put together, and the registered queries."""
