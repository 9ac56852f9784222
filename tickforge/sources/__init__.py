"""Sources: the test-table fixtures, lake readers, message streams, JDBC."""
