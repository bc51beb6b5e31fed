"""Delivery analytics as Spark DataFrame and Spark ML operators."""
