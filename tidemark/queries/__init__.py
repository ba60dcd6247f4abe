"""Registered queries and the SQL their results are compared with."""
