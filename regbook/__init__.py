"""regbook: batch analytics for large registration-style event tables on Spark.

Every operator takes a ``DataFrame`` and returns a ``DataFrame``; column names and
literals are parameters, and the vehicle-registry job is one preset of them.
"""
