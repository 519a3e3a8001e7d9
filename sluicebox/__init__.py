"""sluicebox: profile, clean, validate and transform messy tables on Spark.

Every step either measures columns with one distributed aggregate, decides on
the driver from those few numbers per column, or rewrites the table with one
lazy projection.
"""
