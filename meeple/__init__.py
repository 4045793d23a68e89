"""meeple: catalogue, ratings and recommendation analytics on Spark.

Subpackages: ``sources`` (files, JDBC, Kafka), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame steps), ``plans`` (jobs
and the query catalogue), ``streaming`` (Structured Streaming jobs).
"""
