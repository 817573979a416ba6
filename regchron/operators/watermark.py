"""High-water mark of the incremental load, kept as an append-only log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regchron.functions.columns import iso_date, timestamp
from regchron.schema import CANTONS, INITIAL_WATERMARK, WATERMARK_SCHEMA, WATERMARK_SOURCE


def current_watermark(
    log: DataFrame, source: str = WATERMARK_SOURCE, initial: str = INITIAL_WATERMARK
) -> DataFrame:
    """One row with the newest ``watermark_date`` of a source, or the initial date."""
    return log.filter(F.col("source") == source).agg(
        F.coalesce(F.max("watermark_date"), F.lit(initial).cast("date")).alias("watermark_date")
    )


def read_watermark(log: DataFrame, source: str = WATERMARK_SOURCE) -> str:
    """The watermark as ISO text on the driver."""
    return current_watermark(log, source).first()["watermark_date"].isoformat()


def greatest_date(column: str | Column = "gdat", skip_unreadable: bool = False) -> Column:
    """Aggregate: the greatest date text of the rows."""
    text = F.col(column) if isinstance(column, str) else column
    usable = text != ""
    if skip_unreadable:
        usable = usable & iso_date(text).isNotNull()
    return F.max(F.when(usable, text))


def safe_watermark(
    df: DataFrame,
    column: str = "gdat",
    buffer_days: int = 1,
    previous: str = INITIAL_WATERMARK,
    skip_unreadable: bool = False,
) -> DataFrame:
    """One row: greatest mutation date less the buffer, or the previous mark.

    The greatest is taken over the text, as ISO dates sort like text; if it is no date, or
    there is none, the previous mark stays. With ``skip_unreadable`` text that is no date is
    left out, so that one such value does not hold the mark back.
    """
    greatest = greatest_date(column, skip_unreadable)
    return df.agg(
        F.coalesce(
            F.date_sub(iso_date(greatest), buffer_days), F.lit(previous).cast("date")
        ).alias("watermark_date")
    )


def max_mutation(df: DataFrame, run_id: str | None = None, column: str = "gdat") -> DataFrame:
    """One row with the greatest mutation date of a run's rows."""
    if run_id is not None:
        df = df.filter(F.col("_run_id") == run_id)
    return df.agg(F.max(column).alias(f"max_{column}"))


def advance_watermark(
    log: DataFrame, candidate: date | str, now: datetime, source: str = WATERMARK_SOURCE
) -> DataFrame:
    """The row to append: empty unless ``candidate`` lies behind the newest mark."""
    return (
        current_watermark(log, source)
        .filter(F.col("watermark_date") < F.lit(str(candidate)).cast("date"))
        .select(
            F.lit(source).alias("source"),
            F.lit(str(candidate)).cast("date").alias("watermark_date"),
            timestamp(now).alias("recorded_at"),
        )
    )


def advance_watermarks(log: DataFrame, newest: DataFrame, now: datetime, buffer_days: int = 1) -> DataFrame:
    """The rows to append for several sources at once: (source, gdat) with their greatest date text.

    As with one source, a mark is the date less the buffer, text that is no date moves nothing,
    and a mark moves only forward.
    """
    marks = log.groupBy("source").agg(F.max("watermark_date").alias("known"))
    candidate = F.date_sub(iso_date(F.col("gdat")), buffer_days)
    known = F.coalesce("known", F.lit(INITIAL_WATERMARK).cast("date"))
    return (
        newest.join(marks, "source", "left")
        .withColumn("watermark_date", candidate)
        .filter(F.col("watermark_date") > known)
        .select("source", "watermark_date", timestamp(now).alias("recorded_at"))
    )


def canton_source(canton: str, source: str = WATERMARK_SOURCE) -> str:
    """Name under which the log keeps a canton's own mark."""
    return f"{source}/{canton.upper()}"


def canton_marks(log: DataFrame, source: str = WATERMARK_SOURCE, cantons: Sequence[str] = tuple(CANTONS)) -> DataFrame:
    """(gdekt, watermark_date): the newest mark of each canton that has one.

    At most one row per known canton: names outside the fixed set are left out.
    """
    names = {canton_source(c, source): c.upper() for c in cantons}
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    marks = log.filter(F.col("source").isin(list(names)))
    canton = F.element_at(F.create_map(*pairs), F.col("source"))
    return marks.groupBy(canton.alias("gdekt")).agg(F.max("watermark_date").alias("watermark_date"))


def watermark_rows(spark: SparkSession, rows: list[tuple[str, date, datetime]]) -> DataFrame:
    """Watermark log rows from values on the driver."""
    return spark.createDataFrame(rows, WATERMARK_SCHEMA)


def changed_since(df: DataFrame, watermark: date | str | None, column: str = "gdat") -> DataFrame:
    """Rows mutated after the watermark; all rows for a full load (``None``).

    A date held as text is compared as text, which the Parquet scan can evaluate. Text that is
    no date sorts behind and stays in, and so do rows without a date, rather than being lost.
    """
    if watermark is None:
        return df
    kind = dict(df.dtypes)[column]
    mark = F.lit(str(watermark))
    newer = F.col(column) > (mark if kind == "string" else mark.cast(kind))
    return df.filter(newer | F.col(column).isNull())


def changed_since_marks(
    df: DataFrame, marks: DataFrame, default: date | str, column: str = "gdat", canton: str = "gdekt"
) -> DataFrame:
    """Rows mutated after their canton's mark; a canton without one goes by ``default``.

    ``marks`` holds (gdekt, watermark_date), at most one row per canton, and is broadcast for
    that reason. The earliest of all marks is a literal as well, which reaches the scan. Text is
    compared as in ``changed_since``, and rows without a date stay in.
    """
    found = marks.select(F.col("gdekt").alias("_canton"), F.col("watermark_date").cast("string").alias("_mark"))
    least = found.agg(F.min("_mark").alias("m")).first()["m"]
    earliest = str(default) if least is None else min(least, str(default))
    rows = changed_since(df, earliest, column)
    kind = dict(df.dtypes)[column]
    joined = rows.join(F.broadcast(found), F.col(canton) == F.col("_canton"), "left")
    mark = F.coalesce("_mark", F.lit(str(default)))
    newer = F.col(column) > (mark if kind == "string" else mark.cast(kind))
    return joined.filter(newer | F.col(column).isNull()).drop("_canton", "_mark")


def in_cantons(df: DataFrame, cantons: str | list[str] | None, column: str = "gdekt") -> DataFrame:
    """Rows of the given cantons; all rows if none is named."""
    if not cantons:
        return df
    names = [cantons] if isinstance(cantons, str) else cantons
    return df.filter(F.col(column).isin([c.upper() for c in names]))
