"""Column functions: time, text and wire format."""
