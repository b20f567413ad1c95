"""Operators of a training-data pipeline over document and embedding tables."""
