"""Event and lead analytics as plain Spark jobs, batch and streaming."""
