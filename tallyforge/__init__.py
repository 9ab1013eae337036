"""tallyforge: filing analytics and corpus preparation on Spark DataFrames."""
