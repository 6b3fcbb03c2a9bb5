"""Whole jobs built from the operators, and the queries the driver checks."""
