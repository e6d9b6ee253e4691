"""Operators for preparing training data: text classifiers, quality rules, deduplication, packing, tokenizing, scoring."""
