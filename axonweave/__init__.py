"""Connectome analytics on Spark DataFrames: sources, operators, functions, plans and streaming."""
