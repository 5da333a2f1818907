"""Change-data replication over DataFrames and Structured Streaming."""
