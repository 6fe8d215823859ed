"""DataFrame operators: keyed lookups, windows, audits, profiles and measures."""
