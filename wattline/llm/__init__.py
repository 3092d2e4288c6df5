"""Training-data operators (secret scan, dedup, tokens, mixing, language, toxicity,
sharding, similarity join, nearest neighbours). Nothing else in the library
imports this package; ``queries`` registers one query per operator."""
