"""recordlake: record files, layouts and reports as Spark DataFrames."""
