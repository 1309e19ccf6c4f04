"""Operators of a training-data pipeline (quality, language, duplicates, mixing, tokens, pages)."""
