"""Segment analytics over time-coded media, and operators for training data, on Spark."""
