"""litloom: text mining and analytics over large document collections, on Spark DataFrames."""
