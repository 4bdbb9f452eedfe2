"""Training-data operators: tokens, near duplicates, sharding, classifiers, extraction, decontamination."""
