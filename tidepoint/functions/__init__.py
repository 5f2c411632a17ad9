"""Column functions: time, text, series keys and casts."""
