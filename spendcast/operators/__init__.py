"""DataFrame operators: reshaping, ordering and stable splits."""
