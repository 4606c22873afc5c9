"""Operators of a training-data pipeline over documents, benchmarks, labels and web pages."""
