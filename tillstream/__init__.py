"""tillstream: retail-event analytics on Spark DataFrames."""
