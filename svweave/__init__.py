"""Structural-variant analytics, and training-data operators, on Spark."""
