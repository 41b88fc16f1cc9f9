"""Row-level facets, commitment leftovers, EMR names and the wide table."""
