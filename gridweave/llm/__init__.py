"""Operators on text, vectors and web pages; nothing outside this package imports it."""
