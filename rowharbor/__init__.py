"""Publish tabular files into stored datasets, and keep them in sync, on Spark."""
