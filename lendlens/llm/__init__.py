"""Operators for text corpora, and their queries; nothing else in the library imports them."""
