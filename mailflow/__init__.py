"""mailflow: turn large mail collections into queryable tables with Spark.

Every operator is a function from DataFrames to a DataFrame.  Patterns, word
lists, caps and the reference time are parameters.
"""
