"""Operators: DataFrame -> DataFrame functions, one module per business area."""
