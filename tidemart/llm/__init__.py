"""Operators of a training-data pipeline: one module per operator, queries in ``queries``.

Nothing outside this package imports it; it imports only general helpers from the rest.
"""
