"""Readers: raw extracts, lookups, prior releases, fixes, driver tables."""
