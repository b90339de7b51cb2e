"""Training-data operators: deduplication, filtering, tokenising, search, packing and sharding of documents."""
