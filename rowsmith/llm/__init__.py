"""Operators for preparing training text: cleaning, deduplication, packing and sharding at scale."""
