"""Screening, ranking and evaluation of document collections as PySpark DataFrame operators."""
