"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidespan.sources.scratch import scratch_dir, settle

__all__ = ["process_state", "replacing", "scratch_dir", "settle", "table", "whole"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(name: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def replacing(row: str, names: list[str], **new: Column) -> list[Column]:
    """The fields of the struct column `row`, then the columns `new`, which replace fields of the same name."""
    taken = {n.lower() for n in new}
    kept = [F.col(row).getField(n).alias(n) for n in names if n.lower() not in taken]
    return kept + [c.alias(n) for n, c in new.items()]


def process_state(name: str, make):
    """An object that lives as long as the Python worker process, shared by the tasks that run in it."""
    home = sys.modules.setdefault("_tidespan_llm_state", types.ModuleType("_tidespan_llm_state"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)
