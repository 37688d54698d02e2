"""The whole flow, from source files to rollups."""
