"""Layered bank-data pipelines (raw -> trusted -> rolled up) as Spark DataFrame functions."""
