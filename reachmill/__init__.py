"""Advertising reach, spend and sales analytics as Spark DataFrame plans."""
