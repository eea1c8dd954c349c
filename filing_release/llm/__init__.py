"""Operators for building large text corpora (see README, "Corpus operators")."""
