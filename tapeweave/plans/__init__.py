"""Whole requests built from the operators: export, interchange, back-fill."""
