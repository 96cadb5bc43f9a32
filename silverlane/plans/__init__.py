"""End-to-end flows and the registry of queries with their SQL counterparts."""
