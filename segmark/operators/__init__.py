"""DataFrame -> DataFrame operators: staging, features, rules, ML, marts, quality, reports."""
