"""Machine-learning analytics operators on Spark DataFrames."""
