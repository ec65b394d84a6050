"""Readers: raw lines, delimited and fixed-width text, file listings, layer tables."""
