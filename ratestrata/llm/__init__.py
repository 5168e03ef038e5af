"""Operators for training-data pipelines over `documents` and `embeddings`; nothing else in the library imports them."""
