"""Training-data operators: scoring, filtering, deduplication, tokenisation
and output.  Nothing outside this folder imports it."""
