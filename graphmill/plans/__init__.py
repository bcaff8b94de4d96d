"""Graphs projected from the test tables and the registry of checked queries."""
