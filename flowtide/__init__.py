"""flowtide: value-flow analytics as PySpark DataFrame plans."""
