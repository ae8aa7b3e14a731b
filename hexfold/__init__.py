"""Hexagonal map analytics and training-data operators on Spark."""
