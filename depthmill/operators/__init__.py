"""Relational operators over order-book data."""
