"""Road-traffic analytics on PySpark tables and streams."""
