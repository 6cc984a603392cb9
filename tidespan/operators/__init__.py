"""Operators, grouped by theme and mixed into `TemporalFrame`."""
