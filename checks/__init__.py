"""Test views over the given tables, the query registry and the SQL to compare with."""
