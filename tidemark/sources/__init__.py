"""Table layouts, readers and writers."""
