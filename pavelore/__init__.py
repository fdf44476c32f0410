"""Road-risk analytics as reusable Spark DataFrame operators."""
