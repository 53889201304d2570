"""Table, stream and feature jobs written as PySpark DataFrames."""
