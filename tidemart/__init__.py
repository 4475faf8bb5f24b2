"""Spark-native analytics for shop behaviour events.

Sub-packages: ``sources`` (tables and formats in and out), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame building blocks), ``plans``
(warehouse layers and analyst questions), ``streaming`` (Structured Streaming jobs)
and ``catalog`` (every registered query next to its SQL oracle).
"""
