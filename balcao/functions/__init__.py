"""Column expressions: calendar, ratios, labels, formatting."""
