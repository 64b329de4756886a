"""Operators for cleaning, tokenising, packing and searching training data."""
