"""Layered shop analytics on Spark: bronze, silver and gold as DataFrame functions."""
