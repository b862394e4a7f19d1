"""Operators: parse, profile extraction/enrichment, merges, ids, offsets."""
