"""Entity state-change analytics on Spark DataFrames, in batch and as a stream."""
