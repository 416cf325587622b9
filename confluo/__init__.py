"""confluo: record linkage and table analytics as Spark DataFrame plans."""
