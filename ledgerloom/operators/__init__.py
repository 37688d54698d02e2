"""Operators: typed projection, the order fact and the profit rollups."""
