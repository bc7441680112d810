"""Record files and tables as DataFrames."""
