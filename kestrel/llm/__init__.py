"""Training-data operators: token counts, packing, deduplication, mixing, classifiers, WARC, search, extraction."""
