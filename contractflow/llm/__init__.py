"""Operators of training-data pipelines: one module per operator, queries over the given tables in ``queries``."""
