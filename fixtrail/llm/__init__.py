"""Operators for training corpora: documents, pages and embeddings at scale."""
