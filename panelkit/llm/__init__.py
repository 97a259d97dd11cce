"""Operators for preparing text collections at scale; nothing else in the library imports this package."""
