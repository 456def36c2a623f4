"""Operators that prepare documents, pages and vectors for training language models."""
