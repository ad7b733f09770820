"""Stage functions (features, train, score, marts) and the query catalog."""
