"""Operators: layer transforms, analytic views over gold, quality checks."""
