"""Temporal analytics on Spark: rows with lifetimes, snapshot aggregates, interval joins and patterns."""

import sys

from pyspark import cloudpickle

from .frame import Props, TemporalFrame
from .functions.time import INF, MAX_T, MIN_T, micros

# Tasks receive this package's small functions with the job: executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["INF", "MAX_T", "MIN_T", "Props", "TemporalFrame", "micros"]
