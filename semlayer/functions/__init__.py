"""Measures: the aggregate expressions of a model."""
