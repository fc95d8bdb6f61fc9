"""Batch operators: decode, clean, dedup, star-schema builders, merges,
constraint audit and schema evolution."""
