"""Operators for preparing training data: text, embeddings, web pages and conversations."""
