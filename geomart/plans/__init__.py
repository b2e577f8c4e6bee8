"""Whole-table recipes built from the operators."""
