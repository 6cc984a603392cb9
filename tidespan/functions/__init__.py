"""Scalar and aggregate functions."""
