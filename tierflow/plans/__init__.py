"""Whole-table jobs of the medallion pipeline."""
