"""eddy: keyed-stream analytics written as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame``. Batch forms are plain
DataFrame/SQL plans left to Catalyst; streaming forms use Structured Streaming
(watermarks, windowed aggregation, ``transformWithStateInPandas``).
"""

__all__ = ["session", "config", "schemas"]
