"""decisionlake: lending-decision analytics on PySpark DataFrames."""
