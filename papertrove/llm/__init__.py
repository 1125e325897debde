"""Operators of a training-data pipeline: tokens, secrets, quality, packing, language model, decontamination, duplicates."""
