"""Operators that prepare training data for language models, each usable on its own.

Shared conventions. Operators take and return DataFrames. A null text counts as empty. Where an operator adds a column
that the input already has, the operator's column replaces it. Empty tables give empty results. Repeated rows are
handled one by one unless an operator says otherwise.
"""
