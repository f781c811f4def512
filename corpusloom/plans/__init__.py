"""Whole pipelines composed of operators, and their options."""
