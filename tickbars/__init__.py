"""tickbars: market-feed analytics on Spark.

Batch and Structured Streaming share the same DataFrame -> DataFrame
operator functions; see README.md for the operator map.
"""

__all__ = ["session"]
