"""citeweave: linkage of bibliographic metadata on Spark DataFrames."""
