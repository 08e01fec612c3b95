"""Training-data operators: deduplication, filtering, extraction, scoring, packing, archives."""
