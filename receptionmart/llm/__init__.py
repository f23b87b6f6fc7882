"""Operators that prepare training data, each a module of its own."""
