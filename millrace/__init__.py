"""millrace: change-data and definition-inventory operators for Spark DataFrames."""
