"""Compositions of operators: whole evaluations and the registered queries with their oracles."""
