"""Operators of a training-data pipeline: tokens, search, classifiers, near duplicates, personal data, packing, archives."""
