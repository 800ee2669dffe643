"""Operators of a training-data pipeline (HTML to packed token sequences)."""
