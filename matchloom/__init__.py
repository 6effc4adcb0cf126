"""matchloom: entity resolution over record sources, planned as Spark DataFrames."""
