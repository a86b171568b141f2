"""Publication of person registries with Spark DataFrames."""
