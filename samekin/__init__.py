"""Explainable entity resolution over transaction tables, on PySpark DataFrames."""

__version__ = "0.1.0"
