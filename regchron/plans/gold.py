"""Views over the history: current, history, changes, and their summary."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from regchron.functions.columns import days_valid, status_label
from regchron.schema import KEY

# ---- fixed values: output columns of the views --------------------------------------------
_HISTORY_COLUMNS = [
    "egid", "egrid", "gdekt", "ggdenr", "ggdename", "strname", "deinr", "plz4", "plzname",
    "gstat", "gkat", "gklas", "gbauj", "gabbj", "garea", "gvol", "ganzwhg",
    "valid_from", "valid_to", "is_current", "dqa_deleted", "record_hash",
]
_CURRENT_COLUMNS = [
    "egid", "egrid", "gdekt", "ggdenr", "ggdename", "strname", "deinr", "plz4", "plzname",
    "gstat", "gstat_label", "gkat", "gklas", "gbauj", "gbaup", "gabbj", "garea", "gvol",
    "ganzwhg", "gazzi", "gkode", "gkodn", "gschutzr", "gdatns", "last_mutation_date",
    "valid_from", "record_hash", "_silver_loaded",
]
# ---- end of fixed values ------------------------------------------------------------------


def current_view(history: DataFrame) -> DataFrame:
    """The rows valid now, with the status label: the reference side of the checks."""
    valid = history.filter(F.col("is_current") & ~F.col("dqa_deleted"))
    return valid.withColumns(
        {"gstat_label": status_label("gstat"), "last_mutation_date": F.col("gdat")}
    ).select(*_CURRENT_COLUMNS)


def history_view(history: DataFrame, as_of: date | None = None) -> DataFrame:
    """All versions with ``days_valid``.

    An open version counts to the end of the calendar; ``as_of`` adds ``days_open``, which
    counts it to that day.
    """
    view = history.select(
        *_HISTORY_COLUMNS, days_valid("valid_from", "valid_to").alias("days_valid")
    )
    if as_of is not None:
        view = view.withColumn("days_open", days_valid("valid_from", "valid_to", as_of))
    return view


def ordered_history(view: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Versions in reading order; only for output, as it sorts everything."""
    return view.orderBy(*keys, "valid_from")


def change_view(history: DataFrame, keys: Sequence[str] = (KEY,), status: str = "gstat") -> DataFrame:
    """Keys with more than one version.

    ``latest_`` and ``initial_`` hold the greatest and least status code; ``last_`` and
    ``first_`` the one that is last and first in time. The list of codes is in order of time and
    leaves out NULL; it has one entry per version, and a key gets at most one version per run.
    """
    code = F.col(status)
    dated = F.struct("valid_from", code)
    listed = F.collect_list(F.when(code.isNotNull(), dated))
    return (
        history.groupBy(*keys)
        .agg(
            F.count("*").alias("version_count"),
            F.min("valid_from").alias("first_seen"),
            F.max("valid_from").alias("last_change"),
            F.max(code).alias(f"latest_{status}"),
            F.min(code).alias(f"initial_{status}"),
            F.max(dated)[status].alias(f"last_{status}"),
            F.min(dated)[status].alias(f"first_{status}"),
            F.transform(F.array_sort(listed), lambda e: e[status]).alias(f"{status}_history"),
        )
        .filter(F.col("version_count") > 1)
    )


def history_of(history: DataFrame, key: int, key_column: str = KEY) -> DataFrame:
    """All versions of one key in order of time."""
    return (
        history.filter(F.col(key_column) == key)
        .select(
            key_column, "gstat", "ganzwhg", "valid_from", "valid_to", "is_current", "dqa_deleted"
        )
        .orderBy("valid_from")
    )


def most_changed_key(history: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """The key with the most versions, the lowest one among equals."""
    return (
        history.groupBy(*keys)
        .agg(F.count("*").alias("version_count"))
        .filter(F.col("version_count") > 1)
        .orderBy(F.col("version_count").desc(), *keys)
        .limit(1)
    )


def summary(current: DataFrame) -> DataFrame:
    """One row of totals over the current view.

    Counted per canton, municipality and date first, in one pass without a sort, so that the
    distinct counts and the least and greatest date (text, for which Spark would sort groups) run
    over those rows and not over the buildings.
    """
    codes = (("bestehende", 1004), ("im_bau", 1003), ("geplant", 1001))
    dates = "last_mutation_date"
    small = current.groupBy("gdekt", "ggdenr", dates).agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("gstat") == code).alias(name) for name, code in codes],
    )
    return small.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_buildings"),
        F.count_distinct("gdekt").alias("kantone"),
        F.count_distinct("ggdenr").alias("gemeinden"),
        *[F.sum(name).alias(name) for name, _ in codes],
        F.min(dates).alias("oldest_mutation"),
        F.max(dates).alias("latest_mutation"),
    )


VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "gold_gwr_current": current_view,
    "gold_gwr_history": history_view,
    "gold_gwr_changes": change_view,
}


def publish_views(
    history: DataFrame, views: Mapping[str, Callable[[DataFrame], DataFrame]] = VIEWS
) -> list[str]:
    """Create or replace a view for every entry of the map."""
    for name, build in views.items():
        build(history).createOrReplaceTempView(name)
    return list(views)
