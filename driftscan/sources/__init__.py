"""Readers of archives, side-cars and prediction tables."""
