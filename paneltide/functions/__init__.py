"""Column functions: dates and calendars, codes, arrays."""
