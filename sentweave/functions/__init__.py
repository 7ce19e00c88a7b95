"""Functions of the sentence corpus engine."""
