"""Scalar column expressions. All of them are built-in functions, so they stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime, timezone

from pyspark.sql import Column, functions as F

from regchron.schema import NORMAL_FORMS, STATUS_LABEL_DEFAULT, STATUS_LABELS, WHITESPACE

# Java also reads 1.5d, 2f and 0x1p3 as numbers, the registry does not. Of the texts with one of
# these letters only the infinities are numbers.
_JAVA_LETTERS = "dDfFxX"
_INFINITIES = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc(value: datetime) -> datetime:
    """A moment as UTC without a zone, the form in which all times are stored."""
    return value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value


def sql_timestamp(value: datetime | str) -> str:
    """A time-zone free timestamp literal as SQL text."""
    text = utc(value).isoformat(sep=" ") if isinstance(value, datetime) else value
    return f"timestamp_ntz'{text}'"


def timestamp(value: datetime | str) -> Column:
    """A time-zone free timestamp literal."""
    return F.expr(sql_timestamp(value))


def strip(c: Column | str) -> Column:
    """Remove Unicode white space at both ends (``trim`` alone only removes blanks)."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    """Stripped text, with NULL for an empty value."""
    return F.nullif(strip(c), F.lit(""))


def to_int(c: Column | str, kind: str = "int", strict: bool = False) -> Column:
    """Whole number, NULL for anything else; with ``strict`` bad text fails the job."""
    return blank_to_null(c).cast(kind) if strict else strip(c).try_cast(kind)


def to_double(c: Column | str, strict: bool = False) -> Column:
    """Floating point number, NULL for anything else; ``strict`` as in :func:`to_int`."""
    if strict:
        return blank_to_null(c).cast("double")
    text = strip(c)
    plain = F.translate(text, _JAVA_LETTERS, "") == text
    return F.when(plain | F.lower(text).isin(_INFINITIES), text.try_cast("double"))


def to_type(c: Column | str, kind: str, strict: bool = False) -> Column:
    """Coerce raw text to one of the registry's types."""
    if kind in ("int", "bigint"):
        return to_int(c, kind, strict)
    if kind == "double":
        return to_double(c, strict)
    text = blank_to_null(c)
    if kind == "string":
        return text
    return text.cast(kind) if strict else text.try_cast(kind)


def norm_text(c: Column | str) -> Column:
    """Text in the form in which street names are compared.

    Lower case, stripped, umlauts written out, hyphens as blanks, full stops and commas gone.
    """
    text = strip(F.lower(_col(c).cast("string")))
    for sign, written in NORMAL_FORMS.items():
        text = F.replace(text, F.lit(sign), F.lit(written))
    return text


def row_hash(columns: Iterable[str], strict: bool = False) -> Column:
    """SHA-256 fingerprint over ``columns``, values joined by ``|``.

    The default treats NULL and the empty string alike and does not escape ``|``. With
    ``strict`` each value carries its length and NULL has its own mark, so that different rows
    cannot share a text.
    """
    parts = []
    for name in columns:
        text = f"cast(`{name}` as string)"
        if strict:
            parts.append(f"coalesce(length({text}) || ':' || {text}, '~')")
        else:
            parts.append(f"coalesce({text}, '')")
    return F.expr(f"sha2(concat_ws('|', {', '.join(parts)}), 256)")


def status_label(
    c: Column | str,
    labels: Mapping[int, str] = STATUS_LABELS,
    default: str = STATUS_LABEL_DEFAULT,
) -> Column:
    """Label of a status code, ``default`` for unknown codes and NULL."""
    code = _col(c)
    chain = None
    for value, label in labels.items():
        hit = code == F.lit(value)
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def pct_diff(a: Column | str, b: Column | str) -> Column:
    """Absolute difference of ``a`` from ``b`` in percent of ``b``, taking at least 1 for ``b``."""
    left, right = _col(a).cast("long"), _col(b).cast("long")
    return F.abs(left - right) / F.greatest(right, F.lit(1)) * 100


def shown(c: Column | str) -> Column:
    """A value as it appears in check messages; a missing one reads ``None``."""
    return F.coalesce(_col(c).cast("string"), F.lit("None"))


def contains_text(c: Column | str, part: str) -> Column:
    """Case-insensitive substring test, false for NULL."""
    return F.coalesce(F.lower(_col(c).cast("string")).contains(part.lower()), F.lit(False))


def days_valid(valid_from: Column | str, valid_to: Column | str, as_of: date | str | None = None) -> Column:
    """Days between the ends of validity; with ``as_of`` an open or later end counts as ``as_of``."""
    end = _col(valid_to)
    if as_of is not None:
        end = F.least(end, F.lit(str(as_of)).cast("timestamp_ntz"))
    return F.date_diff(end, _col(valid_from))


def iso_date(c: Column | str) -> Column:
    """Date in the first ten characters of a text, NULL if there is none."""
    return F.try_to_date(F.substring(_col(c).cast("string"), 1, 10), "yyyy-MM-dd")


def mutation_year(c: Column | str) -> Column:
    """Year of a date held as text, NULL for text that is no date."""
    return F.year(iso_date(c))


def day_before(c: Column | str, days: int = 1) -> Column:
    """ISO text of the date ``days`` before the one in ``c``."""
    return F.date_sub(iso_date(c), days).cast("string")
