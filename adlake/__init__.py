"""Advertising analytics on Spark: batch and streaming operators as DataFrame functions."""
