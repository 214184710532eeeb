"""Event correlation as Spark DataFrame plans, batch and streaming."""
