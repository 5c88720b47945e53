"""Operators for preparing language-model training data (loaded by nothing else in this library)."""
