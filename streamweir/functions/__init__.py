"""Column expressions: message codec, seeded draws, time buckets."""
