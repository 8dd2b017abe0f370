"""chorale: Spark-native analytics over public video comments.

Every operator is a plain function from DataFrames to a DataFrame (or from Columns to a Column), so
Catalyst sees one declarative plan per query.  See README.md for the map of modules.
"""
