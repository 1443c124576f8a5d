"""Operators for large training corpora (documents, embeddings); see README."""
