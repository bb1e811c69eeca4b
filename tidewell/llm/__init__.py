"""Training-data pipeline operators: dedup, filtering, packing, extraction, resharding."""
