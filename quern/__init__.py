"""quern: corpus preparation and analytics on Spark DataFrames."""
