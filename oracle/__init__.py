"""SQL counterparts of the registered queries, for checking only."""
