"""Training-data operators: packing, language ID, search, extraction, mixing, deduplication, licences, token counts."""
