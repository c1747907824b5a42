"""Operators for preparing language-model training data; see ``catalog`` for their queries."""
