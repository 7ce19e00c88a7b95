"""Plans of the sentence corpus engine."""
