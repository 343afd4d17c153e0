"""DataFrame operators: lookups, components, merge, resolve, full text, search, hashing."""
