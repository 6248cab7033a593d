"""Training-data operators: sharding, token files, secrets, near-duplicates, toxicity, mixing, decontamination, lengths, line dedup and quality rules."""
