"""Plant analytics written with the Spark DataFrame API."""
