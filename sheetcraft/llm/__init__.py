"""Training-data operators: language, dedup, tokens, extraction, quality, mixing."""
