"""Behaviour, order and web-log analytics as reusable PySpark operators."""
