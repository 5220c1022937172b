"""Brand-mark analytics as Spark DataFrame plans."""
