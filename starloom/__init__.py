"""starloom: Spark jobs that turn dirty retail order data into a checked star schema and reports."""
