"""Column expressions: time zones, numbers, dates and text."""
