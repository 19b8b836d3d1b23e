"""Column-level expressions: risk flags, calendar features, labels and tiers."""
