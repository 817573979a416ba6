"""Lineage columns of the bronze log."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from regchron.functions.columns import utc


def new_run_id() -> str:
    """Eight random hexadecimal digits."""
    return uuid.uuid4().hex[:8]


def _row_in_partition() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def batch_name(run_id: str, batch_size: int) -> Column:
    """Name of a row's block of ``batch_size`` rows: run, partition and number within it.

    Blocks are counted within a partition, as a count over the whole input would need one task
    or another pass. The first partition's blocks carry no partition: input in one partition
    gets run_0000, run_0001, ...
    """
    row_id = F.monotonically_increasing_id()
    partition = F.shiftright(row_id, 33)
    block = F.floor(_row_in_partition() / batch_size)
    return F.when(partition == 0, F.format_string("%s_%04d", F.lit(run_id), block)).otherwise(
        F.format_string("%s_%d_%04d", F.lit(run_id), partition, block)
    )


def stamp_lineage(
    df: DataFrame,
    run_id: str,
    now: datetime,
    source: str,
    full_load: bool,
    batch_size: int = 1000,
    batch_label: str | None = None,
    mark_batches: str | None = None,
) -> DataFrame:
    """Add the six lineage columns; ``batch_label`` replaces the block number (bulk loads).

    ``mark_batches`` names a further column that is true in the first row of each block.
    """
    now = utc(now)
    if batch_label is None:
        batch = batch_name(run_id, batch_size)
    else:
        batch = F.lit(f"{run_id}_{batch_label}")
    marks = {mark_batches: _row_in_partition() % batch_size == 0} if mark_batches else {}
    return df.withColumns(
        {
            "_ingested_at": F.lit(now.isoformat()),
            "_ingestion_date": F.lit(now.date().isoformat()),
            "_run_id": F.lit(run_id),
            "_batch_id": batch,
            "_source": F.lit(source),
            "_is_full_load": F.lit(full_load),
        }
        | marks
    )
