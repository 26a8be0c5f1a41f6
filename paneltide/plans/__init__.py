"""Compositions: adapters onto the driver's tables, look-up pipelines, and the registered queries with their SQL."""
