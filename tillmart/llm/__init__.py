"""Operators for building training data out of raw text, one module each."""
