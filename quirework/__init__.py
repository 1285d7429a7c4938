"""Quirework: a PySpark engine that turns scanned-directory lines into keyed, checked, analysis-ready tables."""
