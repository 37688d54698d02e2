"""Runs the mart over the driver's tables: source shapes, source files, queries, oracles."""
