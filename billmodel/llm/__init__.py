"""Operators and the document pipeline for large training corpora."""
