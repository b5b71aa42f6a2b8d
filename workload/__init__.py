"""Queries over the test tables: adapters, query functions and their SQL twins."""
