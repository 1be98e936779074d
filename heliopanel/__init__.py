"""heliopanel — hourly energy time-series analytics on Spark DataFrames.

Every operator takes and returns a ``pyspark.sql.DataFrame`` over a *panel*:
many series (``keys``, e.g. a site id) each ordered by a time column.
"""

__version__ = "0.1.0"
