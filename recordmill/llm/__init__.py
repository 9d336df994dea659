"""Training-data operators: search, token accounting, deduplication, scoring, filtering and packing."""
