"""cartwheel — session analytics and purchase propensity on Spark.

Every operator takes and returns Spark DataFrames; the heavy lifting is
Catalyst / Tungsten (aggregations, joins, windows) plus ``pyspark.ml`` for
model fitting.  See README.md for the operator map.
"""

__version__ = "0.1.0"
