"""Writing: files, completion records, published tables and views."""
