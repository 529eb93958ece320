"""Clickstream session analytics as plain PySpark DataFrame functions."""
