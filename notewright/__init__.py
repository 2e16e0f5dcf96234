"""Clinical free text to governed, query-ready tables, on Spark DataFrames."""
