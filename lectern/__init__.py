"""Spark-first text analytics: ordered rewriting, residual search, mining and summaries."""
