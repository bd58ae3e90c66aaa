"""Reading and writing of tables, page sets and seed dimensions."""
