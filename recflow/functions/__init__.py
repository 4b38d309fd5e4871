"""Scalar (Column) functions: regex dialect helpers, projections, vocabularies."""
