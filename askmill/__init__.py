"""Batch analytics over large logs of short free-text questions, on Spark DataFrames."""
