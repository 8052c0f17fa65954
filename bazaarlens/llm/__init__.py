"""Operators on corpora and catalogues for training data; nothing else in the library imports this."""
