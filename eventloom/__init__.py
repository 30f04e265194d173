"""Activity analytics for Spark: skewed counts and joins, bursts, enrichment,
growing schemas, output layout and data checks, all as DataFrame functions."""

__version__ = "0.1.0"
