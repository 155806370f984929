"""Operators on free text and for training data; optional, nothing outside imports it."""
