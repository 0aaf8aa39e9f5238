"""Tables, event streams and event-sequence patterns on Spark DataFrames."""
