"""Reading and writing: files, catalog, warehouse."""
