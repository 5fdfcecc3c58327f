"""Operators for preparing training corpora: language ID, quality, near-duplicate
detection, personal data and secret scans, URL filters, mixing, packing and
nearest-neighbour search.  Nothing outside this package imports it."""
