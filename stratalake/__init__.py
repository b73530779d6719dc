"""Nested search results in, clean relational tables and ready-made metrics out, on Spark."""
