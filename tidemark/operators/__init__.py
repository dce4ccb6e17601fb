"""Relational operators: profiling, cell aggregates, port joins, voyages, file sets."""
