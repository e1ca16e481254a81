"""Operators for preparing training corpora: documents, pages, vectors, conversations."""
