"""Compositions of operators: the dataset build (Entry A), the baseline model
(Entry B), the ordinal model (Entry C), inference / comparison, and the
catalogue of registered queries with their SQL oracles."""
