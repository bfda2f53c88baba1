"""Continuous scoring."""
