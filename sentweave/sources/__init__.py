"""Sources of the sentence corpus engine."""
