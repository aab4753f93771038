"""Game-platform analytics on Spark DataFrames and Structured Streaming.

functions  column expressions (keys, times, prices, text)
operators  DataFrame -> DataFrame building blocks (ranking, upsert, scoring, checks)
sources    schemas, tables, topics and landed documents
plans      the queries: views, marts, sentiment, quality, dashboard, recommendations
streaming  topic -> table pipelines
"""
