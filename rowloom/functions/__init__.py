"""Column functions: text, keys and hashes, strict JSON."""
