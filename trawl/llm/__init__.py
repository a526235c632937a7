"""Training-data operators: deduplication, quality, mixing, decontamination, scoring, PII, WARC."""
