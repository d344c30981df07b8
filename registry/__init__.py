"""The registered queries over the given tables, and their SQL counterparts."""
