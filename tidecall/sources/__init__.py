"""Reading and writing: files, catalog tables, generated rows."""
