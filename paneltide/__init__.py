"""Analytics over price-observation panels on Spark."""
