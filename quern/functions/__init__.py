"""Column functions on text and urls."""
