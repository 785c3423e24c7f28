"""Relational operators shared by every layer."""
