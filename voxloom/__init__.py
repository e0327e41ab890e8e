"""voxloom: speech-corpus analytics on Spark DataFrames."""
