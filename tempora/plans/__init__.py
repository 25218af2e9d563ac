"""Composite jobs built from the operators (L1-L11) and the benchmark-table stand-ins."""
