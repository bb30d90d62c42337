"""Operators for preparing text at training-corpus scale.

One module per operator; ``queries`` registers a thin query for each. Nothing
else in the package imports from here.
"""
