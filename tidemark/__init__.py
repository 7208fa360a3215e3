"""tidemark: snapshot-lake analytics as PySpark table operators."""
