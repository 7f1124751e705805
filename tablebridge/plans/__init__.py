"""Queries over connected databases, each with the SQL that must give the same rows."""
