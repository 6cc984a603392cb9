"""Shared folder for written intermediate tables and stream checkpoints.

Operators write tables that later steps read, and cannot know when the last reader is done: the caller can. Inside a
`workspace` all of them go below one folder, which is removed at its end, when the result has been written or collected.
Outside of one they stay.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders of the workspaces that are open, the innermost last.
_open: list[str] = []


def _root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidespan-")
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str, outside: bool = False) -> str:
    """A new folder below `spark.checkpoint.dir`, in the workspace at hand unless `outside` asks for one that stays.

    Only a local session may fall back to a temporary folder.
    """
    home = _open[-1] if _open and not outside else _root(spark)
    return f"{home}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, outside: bool = False) -> DataFrame:
    """Write a table and read it back: later steps neither repeat the work nor depend on lost executors."""
    path = scratch_dir(df.sparkSession, "table", outside)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.tidespan_path = path
    return out


def release(path: str) -> None:
    """Remove a folder of written tables, in whatever store it is."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        path = f"file://{path}"
    store, inner = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    if store.get_file_info(inner).type == fs.FileType.Directory:
        store.delete_dir(inner)


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """What operators write inside is removed at the end; frames made inside cannot be read after it."""
    home = f"{_root(spark)}/run-{uuid.uuid4().hex}"
    _open.append(home)
    try:
        yield home
    finally:
        _open.remove(home)
        release(home)
