"""Operators for preparing training data: documents, embeddings, pages, conversations.

Nothing else in the library imports this subpackage.
"""
