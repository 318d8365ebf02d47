"""Millrace: tabular cleaning, profiling, screening and modelling on Spark.

Every operator takes a DataFrame and returns a tidy DataFrame (one row per
column, pair, category or test).  The packages are

``sources``    readers, sinks, staging, run log
``functions``  type tests, column expressions, tail probabilities
``operators``  the table operators
``plans``      the pipelines that compose them
"""

__version__ = "0.1.0"
