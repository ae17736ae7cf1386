"""Sources: provided-table mapping, lake reads/writes, JDBC, constants."""
