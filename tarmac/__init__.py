"""Flight delay and cancellation analytics as plain Spark DataFrame jobs."""
