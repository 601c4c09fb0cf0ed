"""Booking analytics on Spark: files to history, history to latest state, star
schema, metrics and quality gates. Every operator takes and returns DataFrames."""
