"""Training-data operators: scoring, deduplication, packing, mixing, filtering, token output, search."""
