"""Quillstone: corpus analytics on Spark DataFrames."""
