"""Getting mail in: files, landed tables, incremental pulls and filters."""
