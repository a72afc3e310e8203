"""Whole computations: cleaning a batch, building the warehouse, serving queries."""
