"""Training-data operators: quality, extraction, secrets, PII, language, mixing, dedup, toxicity, search, tokens."""
