"""Relational operators over route networks."""
