"""Operators for training data: tokens, packing, near-duplicates, personal data, contamination, chats."""
