"""Training-data operators: scoring, deduplication, quality, tokens, packing, personal data, language."""
