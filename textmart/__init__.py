"""textmart: posting-text analytics expressed as Spark DataFrame operations."""
