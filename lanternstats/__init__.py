"""Relay-network statistics as Spark DataFrame jobs.

``sources``    files to DataFrames
``functions``  column helpers (text lines, digests, numbers, sizes)
``operators``  parse jobs, joins, comparisons: DataFrame to DataFrame
``plans``      daily aggregates, incremental refresh, keyed tables
``streaming``  the same jobs driven by a file stream
"""
