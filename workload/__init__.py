"""Queries over the supplied tables, and the SQL each is checked against."""
