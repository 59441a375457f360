"""Training-data operators: scoring, quality, privacy, de-duplication, mixing and output."""
