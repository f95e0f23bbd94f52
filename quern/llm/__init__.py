"""Training-data operators: language, mixing, tokens, licences, dedup, search, URLs."""
