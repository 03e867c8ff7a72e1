"""Training-data operators: de-duplication, formatting, filtering, extraction, search, mixing, packing."""
