"""Retail, rental, civic and clickstream analytics as PySpark DataFrame programs.

``functions``  column expressions (money, text, dates, rules)
``operators``  joins, aggregates, windows and shaping over DataFrames
``sources``    readers: CSV, JSON, JDBC, EXIF, Parquet tables
``sinks``      bucketed, partitioned and nested writers
``plans``      the dataset programs, one module per dataset
``streaming``  the click stream job
"""

__version__ = "0.1.0"
