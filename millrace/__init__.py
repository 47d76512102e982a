"""Evidence reconciliation, ranking and retrieval on Spark DataFrames."""
