"""Column functions: text, numbers, time, arrays."""
