"""Column functions: JSON text, headers, durations, strict casts."""
