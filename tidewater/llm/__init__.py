"""Training-data operators: scoring, filtering, deduplication, sharding and packing of text."""
