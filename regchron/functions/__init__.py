"""Column expressions: coercion, normalisation, fingerprints, lineage and checks."""
