"""Registered queries, their oracles, and the file inputs derived from the tables."""
