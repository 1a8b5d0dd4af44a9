"""Training-data operators: scoring, dedup, scans, mixing, packing. Nothing else in the library imports this."""
