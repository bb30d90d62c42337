"""Sources: JDBC reads, local rows, catalog tables."""
