"""Document processing, retrieval and analytics on PySpark DataFrames."""
