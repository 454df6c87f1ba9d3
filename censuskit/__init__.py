"""Bitemporal event features, ranking and evaluation as Spark plans."""
