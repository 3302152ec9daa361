"""Training-data operators: mixing, tokenising, personal data, fingerprints, near-duplicates, classifiers, sharding."""
