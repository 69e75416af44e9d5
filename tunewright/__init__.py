"""tunewright: SQL-workload tuning and episode analytics as Spark jobs."""
