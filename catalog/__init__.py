"""Queries over the given tables, one or more per operator, each with an independent SQL answer where SQL can."""

import sys

from pyspark import cloudpickle

from .base import ORACLES, QUERIES
from . import (  # noqa: F401  (importing registers the queries)
    aggregation,
    io,
    joining,
    lifetimes,
    ordering,
    patterns,
    projection,
    scalars,
    streams,
    workloads,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ORACLES", "QUERIES"]
