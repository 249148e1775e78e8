"""Sources: tables and paths, fixture views, JDBC, streams."""
