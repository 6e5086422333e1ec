"""docmill: preparing and searching document collections with PySpark."""
