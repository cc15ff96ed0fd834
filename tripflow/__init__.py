"""Trip analytics on Spark: sources, operators, marts, models and streams.

Every operator is a function from DataFrames to a DataFrame. Nothing here
schedules or executes work itself; plans stay lazy until a sink or an action.
"""
