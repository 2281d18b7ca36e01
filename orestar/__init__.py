"""orestar: a layered (bronze, silver, gold) sales warehouse on Spark DataFrames."""
