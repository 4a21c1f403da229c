"""Operators that prepare code and text for training language models. Nothing else in the library imports this."""
