"""Composed plans: the three models, request plans, derived datasets."""
