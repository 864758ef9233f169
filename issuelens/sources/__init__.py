"""Readers, writers and the mapping of relational tables to issue documents."""
