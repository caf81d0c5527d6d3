"""Finding and repairing broken fact-to-dimension references after dimension reloads."""
