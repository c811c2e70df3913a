"""Operators for preparing large text corpora: near-duplicate removal, source
mixing, licence scans, toxicity, URL filters, substring and suffix-array
deduplication, fingerprints, packing and exact vector search.

Nothing else in the library imports this subpackage."""
