"""Column builders: expressions over columns, no DataFrame in sight."""
