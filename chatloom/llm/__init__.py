"""Operators of a training-data pipeline: archives, counts, duplicates, filters, packing, shards."""
