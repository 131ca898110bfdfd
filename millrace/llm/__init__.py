"""Training-data operators: quality, language, duplicates, secrets, packing and friends."""
