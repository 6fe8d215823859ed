"""Operators for preparing training text: tokenizers, joins, archives, search, filters, classifiers, packing."""
