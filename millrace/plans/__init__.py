"""Roll-ups, dependencies and ordering over whole inventories."""
