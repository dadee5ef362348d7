"""Whole jobs built from the operators: daily series, weekly store, training, marts."""
