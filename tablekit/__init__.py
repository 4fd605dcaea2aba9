"""Tablekit: DataFrame operators for data work around ML operations, on Spark.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a column
expression builder) written with the DataFrame API, Spark SQL, Structured
Streaming and ``pyspark.ml``.  Nothing is collected to the driver except
bounded metadata (schemas, small size probes).
"""

__version__ = "0.1.0"
