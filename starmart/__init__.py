"""Retail star-schema analytics written as Spark DataFrame functions."""
