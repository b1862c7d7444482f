"""Chunk, shard, per-file and table sinks."""
