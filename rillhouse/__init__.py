"""Layered retail warehouse on Spark: logs and change events to analytic tables."""
