"""airtally: viewing analytics over topic messages, written as Spark jobs."""
