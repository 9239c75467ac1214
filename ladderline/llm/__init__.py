"""Training-data operators: tokenisation, scans, scoring, dedup, packing and search.

Nothing outside this subpackage imports it.
"""
