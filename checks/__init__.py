"""Queries on the supplied tables, and the SQL each is compared with."""
