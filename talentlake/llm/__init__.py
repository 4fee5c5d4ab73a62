"""Training-data operators: deduplication, scoring, scanning, packing."""
