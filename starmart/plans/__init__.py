"""Composed steps: the fact, its checks, the marts and the load jobs."""
