"""PySpark-native processing of metrics, logs, user events and schema-on-read JSON.

Every operator takes and returns DataFrames.  ``functions`` holds column
expressions, ``operators`` the transformations, ``sources`` and ``sinks`` the
readers and writers, ``plans`` the composed queries, ``streaming`` the
Structured Streaming wiring and ``jobs`` the command line entry points.
"""
