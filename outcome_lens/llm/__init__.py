"""Operators for preparing training data: one module per operator, and ``queries`` that binds them.

Nothing else in the package imports this subpackage.
"""
