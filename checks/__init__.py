"""Registered queries with the SQL that states the expected result."""
