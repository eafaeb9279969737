"""Compositions of operators: the serving table and the monthly load."""
