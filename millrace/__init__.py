"""millrace: contract-driven JSON landing, validation, keyed merges and SQL on Spark DataFrames."""
