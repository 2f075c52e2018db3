"""Operators for preparing text corpora: fingerprints, scoring, dedup, mixing,
tokenising. Nothing outside this subpackage imports it."""
