"""Spark ML regression over panel features."""
