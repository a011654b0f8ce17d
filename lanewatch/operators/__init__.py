"""DataFrame operators: filters, sort, profiles, spatial and name joins, metrics."""
