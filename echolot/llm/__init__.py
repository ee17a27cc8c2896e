"""Operators of a pipeline for training data, each with a query over its whole table."""
