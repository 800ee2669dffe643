"""Operators: targets, reduction, imputation, encoding, scaling,
splitting, models, evaluation, search, paths and curves."""
