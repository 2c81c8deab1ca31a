"""Training-data operators: search, tokens, mixing, archives, quality, privacy, duplicates, packing.

Nothing outside this subpackage imports it; ``registry`` lists its queries for the entry file.
"""
