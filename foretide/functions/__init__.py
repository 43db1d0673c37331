"""Column expressions: cleaning, text keys, odds arithmetic."""
