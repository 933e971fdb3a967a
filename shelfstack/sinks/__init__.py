"""Table, view, file and database writers."""
