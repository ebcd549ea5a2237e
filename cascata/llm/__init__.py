"""Operators of a training-data pipeline: one module per operator.

Nothing else in the library imports this subpackage.  ``queries`` registers
one query per operator; the modules keep their own general interfaces.
"""
