"""Queries over the test tables, one function each: (spark, sf_dir) -> DataFrame."""
