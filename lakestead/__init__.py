"""Commerce lakehouse on plain Spark DataFrames: raw documents to star schema to reports."""
