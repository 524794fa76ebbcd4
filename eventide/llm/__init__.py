"""Operators for training-data pipelines over text tables (documents, pages, benchmark)."""
