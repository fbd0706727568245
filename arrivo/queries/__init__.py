"""Registered queries: every operator over the given tables, with the SQL that must agree."""
