"""Multi-table jobs composed from the operators."""
