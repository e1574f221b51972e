"""Operators that prepare text corpora: dedup, extraction, scanning, packing, encoding, quality.

Nothing outside this subpackage imports it.
"""
