"""Multi-channel retail analytics as plain Spark DataFrame functions."""
