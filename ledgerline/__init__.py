"""Cost, audit and lakehouse analytics as plain Spark DataFrame functions."""
