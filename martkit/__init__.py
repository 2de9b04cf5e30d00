"""Daily sales marts and keyed, versioned tables as plain Spark DataFrame jobs."""
