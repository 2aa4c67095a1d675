"""Operators for large-scale training-data preparation (see README, "llm")."""
