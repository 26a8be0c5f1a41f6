"""Panel operators: pure functions from DataFrame to DataFrame, with columns and thresholds as parameters."""
