"""Medallion ingestion, incremental statistics and reconciliation on Spark.

Every function takes DataFrames (or paths) and returns DataFrames; nothing here
collects table rows to the driver.
"""

__version__ = "0.1.0"
