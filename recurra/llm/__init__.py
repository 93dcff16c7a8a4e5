"""Operators for preparing training text: dedup, search, scoring, counting,
sharding and packing. Nothing outside this folder imports it."""
