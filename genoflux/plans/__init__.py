"""Compositions of operators, registered queries and their SQL."""
