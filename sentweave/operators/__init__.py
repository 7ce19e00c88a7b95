"""Operators of the sentence corpus engine."""
