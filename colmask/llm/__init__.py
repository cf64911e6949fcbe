"""Operators for the text of a training corpus."""
