"""Column functions: text cleaning, label parsing, keys and sentiment arithmetic."""
