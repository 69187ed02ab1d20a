"""Column expressions: flags, CIGARs, sequences and seeded hashing."""
