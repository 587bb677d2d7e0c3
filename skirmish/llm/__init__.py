"""Operators for large-scale training-data pipelines, each in a module of its own."""
