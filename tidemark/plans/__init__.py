"""Whole loads, the row-count report, reconcile and the serving queries."""
