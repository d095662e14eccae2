"""Compositions of the operators: the retail batch and the driver testbed."""
