"""Restartable queries: named inputs and outputs, checkpoints, completion, progress."""

from __future__ import annotations

import io
from contextlib import contextmanager, redirect_stdout

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.scratch import scratch_dir


@contextmanager
def _state_store(spark: SparkSession):
    """Queries start with a state store that has typed state and timers; the session's own setting is put back."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class QueryContainer:
    """Named streaming inputs and outputs that run, stop and resume together.

    All operator state lives in the checkpoint folder of each output: running a container again with the same
    `home` resumes where it stopped, with the output of an uninterrupted run.
    """

    def __init__(self, spark: SparkSession, home: str | None = None):
        self.spark = spark
        self.home = home or scratch_dir(spark, "container")
        self.inputs: dict[str, DataFrame] = {}
        self.paths: dict[str, str] = {}
        self.outputs: dict[str, DataFrame] = {}
        self.running: dict[str, StreamingQuery] = {}

    def register_input(self, name: str, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
        """A folder of Parquet files as a named stream; new files are new data."""
        reader = self.spark.readStream.schema(schema)
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        self.paths[name] = path
        self.inputs[name] = reader.parquet(path)
        return self.inputs[name]

    def register_output(self, name: str, df: DataFrame) -> None:
        self.outputs[name] = df

    def path(self, name: str) -> str:
        return f"{self.home}/out/{name}"

    def start(self, trigger: dict | None = None) -> dict[str, StreamingQuery]:
        """Start or resume all outputs that do not run. The default trigger works through what is there and stops."""
        for name, df in self.outputs.items():
            if name in self.running and self.running[name].isActive:
                continue
            writer = df.writeStream.format("parquet").outputMode("append")
            writer = writer.option("checkpointLocation", f"{self.home}/state/{name}").queryName(name)
            writer = writer.trigger(**(trigger or {"availableNow": True}))
            with _state_store(self.spark):
                self.running[name] = writer.start(self.path(name))
        return self.running

    def publish(self, name: str, df: DataFrame) -> None:
        """An output that is a log as well: consumers may attach to it at any time. What it writes is kept in order of
        its triggers, and each consumer has an offset of its own in its checkpoint."""
        self.register_output(name, df)

    def attach(self, name: str, log: str, build, since: int | None = None, trigger: dict | None = None) -> StreamingQuery:
        """Start a consumer of a published log while other queries run: `build(stream)` makes its output `name`.

        It begins with the first row of the log, or with those from the time `since` on, and sees what it would have seen
        had it been there from the beginning. Attached again under its name, it goes on where it was.
        """
        stream = self.spark.readStream.schema(self.outputs[log].schema).parquet(self.path(log))
        if since is not None:
            stream = stream.where(F.col("vs") >= since)
        self.register_output(name, build(stream))
        return self.start(trigger)[name]

    def detach(self, name: str) -> None:
        """Stop a consumer; the log and other consumers go on, and its offset and state stay."""
        self.running.pop(name).stop()
        del self.outputs[name]

    def run(self) -> None:
        """Start, process all available input, stop."""
        for q in self.start().values():
            q.awaitTermination()

    def stop(self) -> None:
        for q in self.running.values():
            q.stop()

    def result(self, name: str) -> DataFrame:
        """What an output has written so far."""
        return self.spark.read.schema(self.outputs[name].schema).parquet(self.path(name))

    def plan(self, name: str) -> str:
        """The executed plan of an output's last trigger."""
        text = io.StringIO()
        with redirect_stdout(text):
            self.running[name].explain()
        return text.getvalue()

    def progress(self, name: str) -> dict:
        """Rows buffered in state, and how far the watermark has come."""
        last = self.running[name].lastProgress
        if last is None:
            return {"input_rows": 0, "state_rows": 0, "watermark": None}
        return {
            "input_rows": last["numInputRows"],
            "state_rows": sum(s["numRowsTotal"] for s in last["stateOperators"]),
            "watermark": last.get("eventTime", {}).get("watermark"),
        }

    def input_rows(self, last_only: bool = False) -> dict[str, int]:
        """Rows that the running outputs have read from each named input, in all recent triggers or the last one."""
        rows = dict.fromkeys(self.inputs, 0)
        for query in self.running.values():
            reports = query.recentProgress if not last_only else [p for p in (query.lastProgress,) if p is not None]
            for source in (s for report in reports for s in report["sources"]):
                for name, path in self.paths.items():
                    if f"{path.rstrip('/')}]" in source["description"]:
                        rows[name] += source["numInputRows"]
        return rows

    def waiting_inputs(self) -> list[str]:
        """Named inputs of which the last triggers read nothing: they hold back the progress of what joins them."""
        return sorted(name for name, n in self.input_rows(last_only=True).items() if n == 0)


#: Files that `replay` makes of a part; as many for each trigger give one part, or a little more, at a time.
REPLAY_FILES = 4


def replay(path: str, *parts: DataFrame, files: int = REPLAY_FILES) -> None:
    """Write tables one after the other into a folder, to be read as a stream in that order.

    Each part is dealt evenly into `files` files. A last part with rows far in the future moves the watermark past all data, so that every window closes;
    filter those rows out of the result.
    """
    for part in parts:
        part.repartition(files).write.mode("append").parquet(path)
