"""Training-data operators: extraction, cleaning, dedup, mixing and token output."""
