"""lakeframe: land media and message streams in lake tables and query them with Spark.

Every public function takes and returns DataFrames (or starts a streaming query),
so one definition serves a table and a stream.  See README.md for the module map.
"""

__version__ = "0.1.0"
