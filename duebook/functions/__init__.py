"""Column-level building blocks: calendar arithmetic, code decoding, bucketing."""
