"""Reading and writing: raw files, layer tables, dead letters, run records."""
