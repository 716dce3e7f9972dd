"""Training-data operators: scoring, filtering, deduplication, extraction and packing of text."""
