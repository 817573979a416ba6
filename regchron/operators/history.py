"""Type-2 history: one join classifies every key and yields closed, kept and new versions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from regchron.functions.columns import row_hash, sql_timestamp, timestamp
from regchron.schema import KEY, OPEN_END

NEW, CHANGED, UNCHANGED, DELETED = "new", "changed", "unchanged", "deleted"
KEPT = "kept"


def current_rows(history: DataFrame) -> DataFrame:
    """Versions that are valid now."""
    return history.filter(F.col("is_current"))


def closed_rows(history: DataFrame) -> DataFrame:
    """Versions that have ended; a merge never touches them."""
    return history.filter(~F.col("is_current"))


def _scope(delete_scope: str | Column | None) -> Column:
    if delete_scope is None or (isinstance(delete_scope, str) and delete_scope == "none"):
        return F.lit(False)
    if isinstance(delete_scope, str):
        return F.lit(True) if delete_scope == "all" else F.expr(delete_scope)
    return delete_scope


def deletes(delete_scope: str | Column | None) -> bool:
    """Whether a scope allows any deletion."""
    return not (delete_scope is None or (isinstance(delete_scope, str) and delete_scope == "none"))


def _joined(
    current: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    delete_scope: str | Column | None,
    compare: Sequence[str] | None,
) -> DataFrame:
    """Full outer join of current (``_cur_``) and staged (``_stg_``) rows, with ``action``.

    Both sides have at most one row per key, so no key can weigh more than any other.
    """

    def side(df: DataFrame, prefix: str, *extra: Column) -> DataFrame:
        mark = row_hash(compare) if compare else F.col("record_hash")
        renamed = [F.expr(f"`{c}` as `{prefix}{c}`") for c in df.columns if c not in keys]
        return df.select(*keys, *renamed, mark.alias(f"{prefix}mark"), *extra)

    in_scope = F.coalesce(_scope(delete_scope), F.lit(False)).alias("_in_scope")
    joined = side(current, "_cur_", in_scope).join(side(staging, "_stg_"), list(keys), "full_outer")
    action = f"""case
        when _cur_mark is null then '{NEW}'
        when _stg_mark is null then if(_in_scope, '{DELETED}', '{KEPT}')
        when _cur_mark = _stg_mark then '{UNCHANGED}'
        else '{CHANGED}' end"""
    return joined.withColumn("action", F.expr(action))


def scd2_classify(
    history: DataFrame,
    staging: DataFrame,
    keys: Sequence[str] = (KEY,),
    delete_scope: str | Column | None = "all",
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """Key and ``action`` (new, changed, unchanged, deleted; kept = vanished out of scope)."""
    joined = _joined(current_rows(history), staging, keys, delete_scope, compare)
    return joined.select(*keys, "action")


def _on_close(moment: str, deleted: str) -> dict[str, str]:
    """What ends with a version, as SQL."""
    return {
        "valid_to": moment,
        "is_current": "false",
        "dqa_deleted": deleted,
        "_silver_loaded": moment,
    }


def _on_open(moment: str) -> dict[str, str]:
    """What begins with a version, as SQL."""
    return {
        "valid_from": moment,
        "valid_to": sql_timestamp(OPEN_END),
        "is_current": "true",
        "dqa_deleted": "false",
        "_silver_loaded": moment,
    }


def scd2_merge(
    current: DataFrame,
    staging: DataFrame,
    now: datetime | str,
    keys: Sequence[str] = (KEY,),
    delete_scope: str | Column | None = None,
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """Current versions after the merge plus the versions it closed, told apart by ``is_current``.

    One pass over each side: unchanged rows pass through, a changed row is closed and followed
    by its successor, an unknown key is inserted, and a vanished key inside ``delete_scope`` is
    closed and marked. ``delete_scope`` is ``"all"``, ``None`` or a condition on current rows.
    ``compare`` limits the comparison to those columns (for a source that fills only some);
    otherwise the stored fingerprints are compared. Merging the same rows again changes nothing.
    """
    moment = sql_timestamp(now)
    staged = set(staging.columns)
    joined = _joined(current, staging, keys, delete_scope, compare)

    # A changed key yields two rows, its closed and its new version, any other key one.
    versions = f"""case action
        when '{NEW}' then array('new')
        when '{CHANGED}' then array('old', 'new')
        else array('old') end"""
    ends = f"action in ('{CHANGED}', '{DELETED}')"
    on_close, on_open = _on_close(moment, f"action = '{DELETED}'"), _on_open(moment)

    def value(name: str, kind: str) -> str:
        if name in keys:
            return f"`{name}`"
        old = f"`_cur_{name}`"
        if name in on_close:
            old = f"if({ends}, {on_close[name]}, {old})"
        new = on_open.get(name, f"`_stg_{name}`" if name in staged else "null")
        return f"if(_version = 'new', cast({new} as {kind}), {old}) as `{name}`"

    return joined.withColumn("_version", F.explode(F.expr(versions))).selectExpr(
        *[value(name, kind) for name, kind in current.dtypes]
    )


# Key and fingerprint of this many rows take about 0.1 GB as a broadcast table.
SMALL_STAGING_ROWS = 1_000_000


def scd2_merge_small(
    current: DataFrame,
    staging: DataFrame,
    now: datetime | str,
    keys: Sequence[str] = (KEY,),
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """The same result without deletions, for at most ``SMALL_STAGING_ROWS`` staged rows.

    Only key and fingerprint of the staged rows are broadcast, so the current rows are neither
    shuffled nor sorted. A second look at the current rows reads their keys and fingerprints
    only and finds the staged rows that change nothing; the others begin a version.
    """
    moment = sql_timestamp(now)
    mark = row_hash(compare) if compare else F.col("record_hash")
    marks = F.broadcast(staging.select(*keys, mark.alias("_stg_mark")))

    compared = current.withColumn("_cur_mark", mark).join(marks, list(keys), "left")
    ends = "coalesce(_cur_mark != _stg_mark, false)"
    on_close = _on_close(moment, "false")
    kept = compared.selectExpr(
        *[
            f"if({ends}, {on_close[c]}, `{c}`) as `{c}`" if c in on_close else f"`{c}`"
            for c in current.columns
        ]
    )

    unchanged = (
        current.select(*keys, mark.alias("_cur_mark"))
        .join(marks, list(keys))
        .filter(F.col("_cur_mark") == F.col("_stg_mark"))
        .select(*keys)
    )
    on_open, staged = _on_open(moment), set(staging.columns)
    opened = staging.join(unchanged, list(keys), "left_anti").selectExpr(
        *[
            f"cast({on_open.get(c, f'`{c}`' if c in staged else 'null')} as {kind}) as `{c}`"
            for c, kind in current.dtypes
        ]
    )
    return kept.unionByName(opened)


def scd2_apply(
    history: DataFrame,
    staging: DataFrame,
    now: datetime | str,
    keys: Sequence[str] = (KEY,),
    delete_scope: str | Column | None = None,
    compare: Sequence[str] | None = None,
    staging_empty: bool | None = None,
) -> DataFrame:
    """The whole history after a merge; closed versions pass through without being joined.

    An empty staging never deletes. Whether it is empty is looked up with one row of it unless
    the caller knows and says so.
    """
    if deletes(delete_scope):
        if staging_empty is None:
            staging_empty = staging.isEmpty()
        if staging_empty:
            delete_scope = None
    merged = scd2_merge(current_rows(history), staging, now, keys, delete_scope, compare)
    return closed_rows(history).unionByName(merged)


def merge_measures(now: datetime | str) -> list[Column]:
    """Aggregates that tell what the merge at ``now`` did."""
    moment = timestamp(now)
    ended = ~F.col("is_current") & (F.col("valid_to") == moment)
    return [
        F.count_if(ended & ~F.col("dqa_deleted")).alias("records_closed"),
        F.count_if(F.col("valid_from") == moment).alias("records_inserted"),
        F.count_if(ended & F.col("dqa_deleted")).alias("records_deleted"),
    ]


def merge_counts(history: DataFrame, now: datetime | str) -> DataFrame:
    """One row: records closed, inserted and deleted by the merge at ``now``."""
    return history.agg(*merge_measures(now))


def as_of_view(history: DataFrame, moment: datetime | str) -> DataFrame:
    """The versions that were valid at a point in time."""
    at = timestamp(moment)
    return history.filter((F.col("valid_from") <= at) & (at < F.col("valid_to")))


def history_violations(history: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Keys that break a rule of the history, with the number of breaches of each rule.

    A key has at most one version per run, so its group is no larger than the number of runs.
    """
    by_time = Window.partitionBy(*keys).orderBy("valid_from", "valid_to")
    is_open = F.col("valid_to") == timestamp(OPEN_END)
    checked = history.withColumn("_next", F.lead("valid_from").over(by_time))
    rules = checked.groupBy(*keys).agg(
        F.greatest(F.count_if(F.col("is_current")) - 1, F.lit(0)).alias("extra_current"),
        F.count_if(F.col("_next") < F.col("valid_to")).alias("overlaps"),
        F.count_if(F.col("valid_from") >= F.col("valid_to")).alias("empty_spans"),
        F.count_if(F.col("is_current") != is_open).alias("wrong_flags"),
    )
    broken = F.col("extra_current") + F.col("overlaps") + F.col("empty_spans") + F.col("wrong_flags")
    return rules.filter(broken > 0)

