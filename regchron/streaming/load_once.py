"""Streams whose micro-batches are runs of the log, each of them exactly once.

A run goes through steps: it is begun, published, noted, and merged if the caller wants that. Every step
can be repeated without harm, and Spark repeats a micro-batch until all of them are done: its checkpoint
says which files a batch has, and a small file beside it says under which run id and time the batch was
first tried. So a job that dies between any two steps goes on from there, and the log and the history become
what they would have been.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession

from regchron.functions.columns import utc
from regchron.functions.lineage import new_run_id, stamp_lineage
from regchron.schema import bulk_columns
from regchron.sources.delimited import TSV_OPTIONS, coerce_registry
from regchron.sources.tables import path_exists, publish_run


class Run(NamedTuple):
    """A micro-batch as a run of the log."""

    run_id: str
    loaded_at: datetime
    counts: dict = {}

    @property
    def records(self) -> int:
        return self.counts.get("written", 0)


Step = Callable[[Run], None]


def _nothing(run: Run) -> None:
    """A step that is left out."""


def run_of_batch(spark: SparkSession, checkpoint: str, batch_id: int, new: Run) -> Run:
    """The run of a micro-batch: ``new``, or the one it was begun as when it was tried before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/runs/{batch_id}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path) and fs.getFileStatus(path).getLen():
        text = "".join(r["value"] for r in spark.read.text(path.toString()).collect())
        # A file that was cut off while it was written has begun nothing.
        if text.endswith("}"):
            found = json.loads(text)
            return Run(found["run_id"], datetime.fromisoformat(found["loaded_at"]))
    out = fs.create(path, True)
    try:
        out.write(bytearray(json.dumps({"run_id": new.run_id, "loaded_at": utc(new.loaded_at).isoformat()}).encode()))
    finally:
        out.close()
    return new


def each_batch_once(
    rows: DataFrame,
    checkpoint: str,
    run_id: str,
    now: datetime,
    publish: Callable[[DataFrame, Run], Run],
    begin: Step = _nothing,
    note: Step = _nothing,
    merge: Step = _nothing,
    on_step: Callable[[str, str], None] = lambda step, run_id: None,
) -> list[Run]:
    """Run a stream until it has seen everything; its micro-batches become runs.

    ``publish`` writes a batch's rows so that writing them again replaces them. ``on_step`` is
    called with the name of a step and the run id when the step is done. The first new batch
    gets ``run_id``, others a number behind it.
    """
    spark = rows.sparkSession
    done: list[Run] = []

    def apply(batch: DataFrame, batch_id: int) -> None:
        name = f"{run_id}_{len(done)}" if done else run_id
        run = run_of_batch(spark, checkpoint, batch_id, Run(name, utc(now)))
        begin(run)
        on_step("begun", run.run_id)
        run = publish(batch, run)
        on_step("published", run.run_id)
        note(run)
        on_step("noted", run.run_id)
        merge(run)
        on_step("merged", run.run_id)
        done.append(run)

    stream = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start().awaitTermination()
    return done


def load_files_once(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    now: datetime,
    run_id: str | None = None,
    source: str = "gwr_zip",
    full_load: bool = False,
    strict: bool = True,
    names: dict[str, str] | None = None,
    measures: Sequence[Column] = (),
    **steps,
) -> dict:
    """Append the extract files below ``src`` that were not loaded before to the log ``dst``.

    A file stream that stops when it has seen everything. ``checkpoint`` remembers the files
    read, and a run's rows are a partition of the log that is written as a whole, so a load that
    is repeated after a failure adds nothing twice and leaves nothing out. ``dst`` belongs to
    this loader: it is read as a log of its own next to the one of the batch jobs. With
    ``strict`` a value of the wrong type fails the load. As only new files are read, a load
    counts as full (what it lacks is gone) only if the caller knows the set of files to be
    complete and says so. ``measures`` are observed while a run is written; ``steps`` are those
    of ``each_batch_once``.
    """
    run_id = run_id or new_run_id()
    if path_exists(spark, f"{dst}/_spark_metadata"):
        raise ValueError(f"{dst} was written by a file sink, whose list of files would hide new ones")
    header = spark.read.options(**TSV_OPTIONS).csv(src).schema
    options = TSV_OPTIONS | {"enforceSchema": "false"}
    raw = spark.readStream.schema(header).options(**options).csv(src)
    typed = coerce_registry(raw, names or bulk_columns(), strict)

    def publish(batch: DataFrame, run: Run) -> Run:
        rows = stamp_lineage(batch, run.run_id, run.loaded_at, source, full_load, batch_label="bulk")
        return run._replace(counts=publish_run(rows, dst, measures))

    runs = each_batch_once(typed, checkpoint, run_id, now, publish, **steps)
    runs = [run for run in runs if run.records]
    return {
        "run_id": runs[0].run_id if len(runs) == 1 else run_id,
        "records": sum(run.records for run in runs),
        "runs": [run.run_id for run in runs],
    }
