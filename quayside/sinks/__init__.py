"""Where rows go: partitioned tables, JDBC, Kafka."""
