"""Operators of a training-data pipeline: sharding, archives, tokenizers, filters, joins, packing."""
