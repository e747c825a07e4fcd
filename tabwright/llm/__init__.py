"""Operators over training text: scoring, search, deduplication, sharding, mixing and encoding."""
