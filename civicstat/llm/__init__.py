"""Operators for preparing training data: one module per operator, plus their registered queries."""
