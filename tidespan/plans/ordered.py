"""Ordered scan of each group by a small state machine, or of all its values by a function.

Rows are laid out by group and sorted, and each task reads its sorted rows batch by batch: no group is held in
memory, only the machine's own state is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructField, StructType


def scan_ordered(df: DataFrame, group, order, machine, schema: StructType) -> DataFrame:
    """`machine(key)` starts a group; its `row(values)` and `end()` return lists of output tuples.

    `values` follows the columns of `df`.
    """
    arrow = to_arrow_schema(schema)
    positions = [df.columns.index(c) for c in group]
    rows = df.repartition(*group).sortWithinPartitions(*group, *order)

    def run(batches):
        import pyarrow as pa

        def packed(out):
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        key, now = None, None
        for batch in batches:
            out = []
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                this = tuple(values[p] for p in positions)
                if now is None or this != key:
                    if now is not None:
                        out.extend(now.end())
                    key, now = this, machine(this)
                out.extend(now.row(values))
            if out:
                yield packed(out)
        if now is not None:
            out = now.end()
            if out:
                yield packed(out)

    return rows.mapInArrow(run, schema)


def call_by_group(df: DataFrame, group, value: str, fn, name: str, kind: str) -> DataFrame:
    """For each group the other columns of `df`, and as `name` what `fn` makes of a pandas series of its numbers `value`.

    A task reads its sorted rows batch by batch and holds the numbers of one group.
    """
    start = F.row_number().over(Window.partitionBy(*[F.col(f"`{c}`") for c in group]).orderBy("ve")) == 1
    rest = [c for c in df.columns if c != value]
    rows = df.select(*rest, value, start.alias("_starts"))
    schema = StructType([*[df.schema[c] for c in rest], StructField(name, DataType.fromDDL(kind))])
    arrow = to_arrow_schema(schema)

    def run(batches):
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        def packed(heads, results):
            if len({type(r) for r in results}) == 1:
                last = pa.Array.from_pandas(pd.Series(results), type=arrow.field(name).type, safe=False)
            else:  # as one by one
                last = pa.concat_arrays([pa.Array.from_pandas(pd.Series([r]), type=arrow.field(name).type, safe=False) for r in results])
            return pa.RecordBatch.from_arrays([*[heads.column(i).cast(arrow.field(i).type) for i in range(len(rest))], last], schema=arrow)

        head, held = None, []
        for batch in batches:
            values = batch.column(len(rest))
            starts = np.flatnonzero(batch.column(len(rest) + 1).to_numpy(zero_copy_only=False))
            if not len(starts):
                held.append(values)
                continue
            if head is not None:
                held.append(values.slice(0, starts[0]))
                yield packed(head, [fn(pa.concat_arrays(held).to_pandas())])
            bounds = starts.tolist()
            if len(bounds) > 1:
                if values.null_count:
                    parts = (values.slice(a, b - a).to_pandas() for a, b in zip(bounds, bounds[1:], strict=False))
                else:
                    plain = np.array(values)
                    parts = (pd.Series(plain[a:b], copy=False) for a, b in zip(bounds, bounds[1:], strict=False))
                yield packed(batch.take(pa.array(starts[:-1])), [fn(p) for p in parts])
            head, held = batch.slice(bounds[-1], 1), [values.slice(bounds[-1])]
        if head is not None:
            yield packed(head, [fn(pa.concat_arrays(held).to_pandas())])

    return rows.mapInArrow(run, schema)
