"""Whole steps made of operators: clean, features, training, monitoring."""
