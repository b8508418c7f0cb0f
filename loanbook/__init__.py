"""Weekly loan-book views on Spark DataFrames."""
