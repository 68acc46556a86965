"""Training-data operators: deduplication, counting, classification, packing."""
