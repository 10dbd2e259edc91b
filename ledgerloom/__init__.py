"""ledgerloom: public-finance tables on Spark.

Every capability is a function from DataFrames (and plain parameters) to a
DataFrame, so callers can chain them and leave the physical plan to Spark.
"""
