"""Operators assembled into whole queries, and the SQL they are checked against."""
