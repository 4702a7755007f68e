"""Operators for text corpora and crowd labels; nothing else in the library imports these."""
