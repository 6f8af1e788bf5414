"""Column functions: calendar parts, ratios, JSON checks."""
