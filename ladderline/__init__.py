"""Ladderline: prediction-market microstructure analytics on Spark DataFrames."""
