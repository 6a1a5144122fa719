"""Binding to the given tables: adapters, the registered queries and their SQL."""
