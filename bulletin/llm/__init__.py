"""Training-data operators: deduplication, filtering, extraction, mixing and sharding of large corpora."""
