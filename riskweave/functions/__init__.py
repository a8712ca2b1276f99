"""Column functions: bands, text, small numeric helpers."""
