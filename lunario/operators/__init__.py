"""Relational operators over monthly series."""
