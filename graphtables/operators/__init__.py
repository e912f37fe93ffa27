"""Mutations, statement tables, edge queries and graph export."""
