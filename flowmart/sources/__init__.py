"""Sources: message streams, raw JSON trees, zone tables, published tables."""
