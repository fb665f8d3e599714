"""Marketplace order events as Spark DataFrames: parse, filter, flatten, enrich, upsert."""
