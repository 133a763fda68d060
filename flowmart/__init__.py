"""Road-sensor analytics on Spark: landing, aggregation, classified marts, publishing and dashboard queries.

Every operator is a function from DataFrames to a DataFrame. Nothing here creates a session, sets a master or
reads the clock by itself: the caller passes the session and the time of the run.
"""
