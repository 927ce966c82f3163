"""Column expressions: dates, labels, arithmetic."""
