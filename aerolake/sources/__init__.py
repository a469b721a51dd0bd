"""Readers for raw files, station extracts, manifests and lookup tables."""
