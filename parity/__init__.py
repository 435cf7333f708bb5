"""Checks against the given tables: raw frames made from them, queries and their SQL twins."""
