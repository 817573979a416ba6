"""Newest row per key of the log, with its fingerprint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from regchron.functions.columns import iso_date, row_hash
from regchron.schema import HASH_COLUMNS, KEY, REGISTRY_COLUMNS


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order_by``. Rows without a key are left out.

    Spark plans the ``row_number = 1`` filter as a window group limit, which keeps one row per
    key in each task before the shuffle. A key with most of the rows therefore sends one row
    per task, and the group that arrives in one place is no larger than the number of tasks.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def build_staging(
    bronze: DataFrame,
    run_id: str | None = None,
    keys: Sequence[str] = (KEY,),
    hash_columns: Sequence[str] = tuple(HASH_COLUMNS),
    order_by: Sequence[Column] | None = None,
    tie_break: Sequence[Column] = (),
    strict_hash: bool = False,
    per_run: bool = False,
) -> DataFrame:
    """The rows a merge works on: newest row per key with ``record_hash``.

    All rows of a run carry the same ``_ingested_at``; ``tie_break`` and then the values of the
    hashed columns, greatest first, decide between duplicates, so the choice does not depend on
    the order of arrival. Only the rows that are left are hashed. With ``per_run`` one row per
    key and run is kept, the input of a replay of many runs.
    """
    if run_id is not None:
        bronze = bronze.filter(F.col("_run_id") == run_id)
    order = list(order_by) if order_by is not None else [F.col("_ingested_at").desc()]
    group = [*keys, "_run_id"] if per_run else list(keys)
    values = [F.col(c).desc_nulls_last() for c in hash_columns]
    newest = latest_per_key(bronze, group, [*order, *tie_break, *values])
    return newest.withColumn("record_hash", row_hash(hash_columns, strict_hash))


def newest_state() -> list[Column]:
    """Order of the states of a key within a run: the latest mutation first, undated ones last."""
    return [iso_date(F.col("gdat")).desc_nulls_last()]


def carry_forward(
    staging: DataFrame,
    current: DataFrame,
    filled: Sequence[str],
    keys: Sequence[str] = (KEY,),
    columns: Sequence[str] = tuple(REGISTRY_COLUMNS),
    hash_columns: Sequence[str] = tuple(HASH_COLUMNS),
) -> DataFrame:
    """Staged rows of a source that fills only some columns, completed from the current rows.

    Columns outside ``filled`` keep the value the key has now (NULL for a new key), and the
    fingerprint is taken from the completed row. So a source that does not know a column neither
    blanks it nor opens a version because of it. Both sides have one row per key.
    """
    missing = [c for c in columns if c not in filled and c not in keys]
    if not missing:
        return staging
    known = current.select(*keys, *missing)
    completed = staging.drop("record_hash", *missing).join(known, list(keys), "left")
    return completed.withColumn("record_hash", row_hash(hash_columns))
