"""Operators for building training corpora: ten jobs over documents, vectors and pages."""
