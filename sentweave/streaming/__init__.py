"""Streaming of the sentence corpus engine."""
