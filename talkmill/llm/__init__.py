"""Operators for training data of language models, and the queries over them."""
