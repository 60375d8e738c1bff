"""Sales warehouse jobs on Spark."""
