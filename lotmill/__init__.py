"""lotmill: listing intelligence and training-data preparation on Spark DataFrames."""
