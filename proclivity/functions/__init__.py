"""Column functions and the exact-rank building blocks."""
