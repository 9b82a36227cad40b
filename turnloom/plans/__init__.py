"""Queries over the operators, and equivalent SQL."""
