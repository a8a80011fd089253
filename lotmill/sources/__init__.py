"""Inputs: landed pages, registry files, and listing views over the given tables."""
