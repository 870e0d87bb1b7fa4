"""feedback_lens: review analytics on Spark DataFrames."""
