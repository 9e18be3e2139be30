"""carelake: claims analytics as Spark DataFrame transformations.

Every public function takes DataFrames (or a SparkSession plus a path) and
returns a lazy DataFrame; Catalyst plans it and Spark runs it. Only the
functions in :mod:`carelake.sources.sinks` and :mod:`carelake.plans` write.
"""

__version__ = "0.1.0"
