"""Batch and streaming inference over time-series bars, as Spark DataFrame operators."""

__version__ = "0.1.0"
