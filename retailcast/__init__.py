"""retailcast: retail time-series analytics as lazy Spark DataFrame transforms.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects (or
``Column`` expressions) and never pulls row data to the driver, so the same
code runs on ``local[8]`` and on a large cluster.
"""

__version__ = "0.1.0"
