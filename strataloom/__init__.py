"""Layered data warehouses on Spark: land, clean, model, derive marts, refresh."""

__version__ = "0.1.0"
