"""Registered queries: every operator run over the whole given tables."""
