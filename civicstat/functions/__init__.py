"""Column-level helpers: labels, text, lenient numbers and tolerance rules."""
