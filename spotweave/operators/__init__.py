"""Operators: pure DataFrame -> DataFrame functions."""
