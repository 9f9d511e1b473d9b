"""Training-data operators: dedup, quality, language, extraction, search, tokenising and packing."""
