"""Operators of a training-data pipeline.  Nothing else in the library imports this package.

Each module holds one operator with a general interface and the thin query ``opN_<name>``
that applies it to a whole table; ``queries`` gathers them for the driver contract.
"""
