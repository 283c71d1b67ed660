"""Composition of the operators: one full build, the registered queries and their oracle SQL."""
