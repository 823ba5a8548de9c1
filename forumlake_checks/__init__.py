"""Registered queries over the provided tables and the SQL they are compared with."""
