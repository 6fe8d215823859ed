"""Check queries: inputs derived from the driver tables, the queries, and their SQL counterparts."""
