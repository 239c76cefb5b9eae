"""weftline: durable-workflow event analytics and corpus preparation on Spark DataFrames."""
