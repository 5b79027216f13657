"""Column functions: text to value, month names and sets, bands and causes."""
