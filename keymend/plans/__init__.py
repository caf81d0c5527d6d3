"""Specifications, configuration parsing and whole runs."""
