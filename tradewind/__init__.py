"""Customer and product analytics over business-to-business sales, written as plain Spark jobs."""
