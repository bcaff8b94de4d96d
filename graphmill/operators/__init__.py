"""Graph operators: centralities, paths, clustering, components, communities."""
