"""Entity linkage and text search as Spark DataFrame plans."""
