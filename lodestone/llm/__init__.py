"""Training-data operators: search, dedup, mixing, packing, scoring, filtering and extraction.

Nothing outside this subpackage imports it.
"""
