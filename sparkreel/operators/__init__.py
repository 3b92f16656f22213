"""Relational operators over samples, rounds, predictions and frames."""
