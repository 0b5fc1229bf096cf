"""Scalar semantics and business rules as Spark column expressions."""
