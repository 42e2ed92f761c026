"""Evidence tables, integrity rules and reports as Spark jobs."""
