"""fieldbook: operations-analytics jobs for a service business, written for Spark.

Every job is a plain function from DataFrames (and an explicit as-of date) to a
DataFrame. Nothing in a job body collects, loops over rows or calls a Python UDF.
"""
