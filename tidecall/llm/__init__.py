"""Operators for training-data corpora: joins of near copies, filters, packing and sharding."""
