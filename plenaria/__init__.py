"""plenaria - analytics over the public records of a parliament, on Spark DataFrames."""
