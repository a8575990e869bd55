"""Operators for training-data problems on names, values, batches, tokens, mixes and languages."""
