"""Column functions: text helpers and tokenizers."""
