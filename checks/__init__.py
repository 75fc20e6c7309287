"""Registered queries on the given tables, and the SQL each is compared with."""
