"""Reading records into DataFrames and writing the results."""
