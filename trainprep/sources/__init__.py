"""File and parquet sources."""
