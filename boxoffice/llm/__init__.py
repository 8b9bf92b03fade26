"""Operators for preparing language-model training data, one module each.

Nothing outside this package imports it; ``queries`` registers the operators."""
