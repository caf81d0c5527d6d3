"""Column functions on natural keys and dates."""
