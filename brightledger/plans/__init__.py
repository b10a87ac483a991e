"""Registered queries: each binds operators to the tables, with its SQL twin."""
