"""Data-lake analytics jobs written as Spark DataFrame, SQL and streaming plans."""
