"""Operators on tables: constraints, merges, deletes and updates, definitions, generations, as-of joins."""
