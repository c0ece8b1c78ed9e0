"""Incident analytics on Spark DataFrames: ingest, keyed upserts, calendar, views."""
