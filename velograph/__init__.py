"""velograph — sensor time-series analytics as Spark DataFrame operators.

Every public operator is a lazy ``DataFrame -> DataFrame`` function; the
canonical data model is the long readings table
``(timestamp TIMESTAMP, edge_id STRING, speed DOUBLE)``.
"""

__version__ = "0.1.0"
