"""Operators for training data: search, filters, duplicates, classifiers, mixing, tokens."""
