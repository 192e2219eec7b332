"""Operators for preparing training data: chat formats, filters, duplicates, packing, tokens."""
