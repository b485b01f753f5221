"""Reading boundary layers into DataFrames and writing display products."""
