"""Sources and sinks: bronze files, driver tables, snapshots, JDBC, profiles."""
