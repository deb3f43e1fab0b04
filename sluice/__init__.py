"""sluice: a Spark-native ingestion, data-quality and table-maintenance library.

Every operator is a plain function from DataFrame(s) to DataFrame built from
Spark SQL / DataFrame / Structured Streaming primitives.
"""

__version__ = "0.1.0"
