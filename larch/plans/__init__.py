"""End-to-end plans composed from the operators (one per query)."""
