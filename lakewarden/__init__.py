"""Lakehouse-operations analytics as plain DataFrame functions on the public Spark API."""

__version__ = "0.1.0"
