"""Operators for training-data pipelines; optional, nothing else in the package imports them."""
