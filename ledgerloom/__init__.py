"""ledgerloom: historical price analytics and corpus preparation on Spark DataFrames."""
