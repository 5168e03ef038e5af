"""Continuous arrival of landing files."""
