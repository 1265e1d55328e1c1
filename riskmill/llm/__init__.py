"""Operators for training corpora: sampling, classifiers, similarity joins, archives and packing."""
