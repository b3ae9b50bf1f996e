"""Content-addressed archive analytics on Spark."""
