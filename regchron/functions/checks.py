"""Data-quality checks: each is one struct column over a record and its reference row.

A check is a function ``(Subject) -> Column``; ``CHECKS`` is the ordered registry. Adding a check
means adding a function to the map (or passing another map to ``run_checks``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, functions as F

from regchron.functions.columns import contains_text, norm_text, pct_diff, shown, strip
from regchron.schema import UNFINISHED_STATES

# ---- fixed values: names, severities and messages as the results must show them -----------
EXISTS_ID, EXISTS_NAME = "GWR-01", "EGID im GWR vorhanden"
ADDRESS_ID, ADDRESS_NAME = "GWR-02", "Adresse korrekt (PLZ + Strasse)"
ADDRESS_SHORT = "Adresse korrekt"
YEAR_ID, YEAR_NAME = "GWR-03", "Baujahr plausibel und GWR-konform"
YEAR_SHORT = "Baujahr plausibel"
STATUS_ID, STATUS_NAME = "GWR-04", "Gebäudestatus konsistent mit Nutzung"
STATUS_SHORT = "Gebäudestatus plausibel"
DWELLINGS_ID, DWELLINGS_NAME = "GWR-05", "Anzahl Wohnungen konsistent (±10%)"
DWELLINGS_SHORT = "Anzahl Wohnungen konsistent"

CRITICAL, WARNING, INFO = "critical", "warning", "info"

SKIPPED_TEXT = "Kein GWR-Record vorhanden — Check übersprungen."
NOT_FOUND_TEXT = "EGID %s nicht im GWR gefunden oder gelöscht."
ADDRESS_TEXT = "PLZ: %s vs. GWR: %s | Strasse: %s vs. GWR: %s"
NO_YEAR_TEXT = "Kein Baujahr im Immobilien-Datensatz vorhanden."
YEAR_RANGE_TEXT = "Baujahr %s ausserhalb Bereich (%s-%s)"
YEAR_DIFFERS_TEXT = "Baujahr %s weicht von GWR ab (%s)"
STATUS_TEXT = "Gebäude hat GWR-Status %s (%s), aber Nutzungsart ist '%s'."
STATUS_EXPECTED = "gstat=4 für bewohntes Objekt"
NO_DWELLINGS_TEXT = "Wohnungsanzahl nicht in beiden Quellen vorhanden — übersprungen."
DWELLINGS_TEXT = "Abweichung: %s vs. GWR: %s (%.1f%%)"
PRESENT, ABSENT = "vorhanden", "nicht gefunden"
# ---- end of fixed values ------------------------------------------------------------------


@dataclass(frozen=True)
class Subject:
    """What a check sees: column lookups for both sides, and the parameters of the run."""

    record: Callable[[str], Column]
    reference: Callable[[str], Column]
    found: Column
    as_of: date
    first_year: int = 1700
    unfinished: Sequence[int] = field(default_factory=lambda: UNFINISHED_STATES)
    let_word: str = "vermietet"
    tolerance_pct: float = 10.0


def outcome(
    check_id: str,
    name: Column | str,
    passed: Column | bool,
    severity: str,
    detail: Column | str = "",
    expected: Column | None = None,
    actual: Column | None = None,
) -> Column:
    """The struct of one result."""

    def text(value: Column | str | None) -> Column:
        value = value if isinstance(value, Column) else F.lit(value)
        return value.cast("string")

    return F.struct(
        F.lit(check_id).alias("check_id"),
        text(name).alias("check_name"),
        (passed if isinstance(passed, Column) else F.lit(passed)).alias("passed"),
        F.lit(severity).alias("severity"),
        text(detail).alias("detail"),
        text(expected).alias("expected"),
        text(actual).alias("actual"),
    )


def skipped(check_id: str, name: str, detail: str = SKIPPED_TEXT) -> Column:
    """Result of a check that has nothing to compare with: passed, for information."""
    return outcome(check_id, name, True, INFO, detail)


def _unless(passed: Column, detail: Column) -> Column:
    return F.when(passed, F.lit("")).otherwise(detail)


def key_exists(s: Subject) -> Column:
    """The key is known to the reference."""
    return outcome(
        EXISTS_ID,
        EXISTS_NAME,
        s.found,
        CRITICAL,
        _unless(s.found, F.format_string(NOT_FOUND_TEXT, shown(s.record("egid")))),
        F.lit(PRESENT),
        F.when(s.found, F.lit(PRESENT)).otherwise(F.lit(ABSENT)),
    )


def address_matches(s: Subject) -> Column:
    """Postcode and normalised street name agree; two missing values agree, one does not."""
    plz, strasse = s.record("plz"), s.record("strasse")
    plz4, strname = s.reference("plz4"), s.reference("strname")
    passed = strip(plz).eqNullSafe(strip(plz4)) & norm_text(strasse).eqNullSafe(norm_text(strname))
    detail = F.format_string(ADDRESS_TEXT, shown(plz), shown(plz4), shown(strasse), shown(strname))
    compared = outcome(
        ADDRESS_ID,
        ADDRESS_NAME,
        passed,
        WARNING,
        _unless(passed, detail),
        F.concat_ws(" ", shown(plz4), shown(strname)),
        F.concat_ws(" ", shown(plz), shown(strasse)),
    )
    return F.when(s.found, compared).otherwise(skipped(ADDRESS_ID, ADDRESS_SHORT))


def year_plausible(s: Subject) -> Column:
    """Building year given, in range, and equal to the reference's where that has one."""
    year, known = s.record("baujahr"), s.reference("gbauj")
    in_range = year.between(s.first_year, s.as_of.year)
    agrees = known.isNull() | (year == known)
    out_of_range = F.format_string(
        YEAR_RANGE_TEXT, shown(year), F.lit(str(s.first_year)), F.lit(str(s.as_of.year))
    )
    differs = F.format_string(YEAR_DIFFERS_TEXT, shown(year), shown(known))
    passed = in_range & agrees
    compared = outcome(
        YEAR_ID,
        YEAR_NAME,
        passed,
        WARNING,
        _unless(passed, F.when(~in_range, out_of_range).otherwise(differs)),
        known,
        year,
    )
    missing = outcome(YEAR_ID, YEAR_SHORT, False, WARNING, NO_YEAR_TEXT)
    return F.when(year.isNull(), missing).otherwise(compared)


def status_fits_use(s: Subject) -> Column:
    """A building that is not finished cannot be let."""
    code, use = s.reference("gstat"), s.record("nutzungsart")
    unfinished = F.coalesce(code.isin(list(s.unfinished)), F.lit(False))
    passed = ~(unfinished & contains_text(use, s.let_word))
    detail = F.format_string(
        STATUS_TEXT, shown(code), F.coalesce(s.reference("gstat_label"), F.lit("")), shown(use)
    )
    compared = outcome(
        STATUS_ID,
        STATUS_NAME,
        passed,
        CRITICAL,
        _unless(passed, detail),
        F.lit(STATUS_EXPECTED),
        F.concat(F.lit("gstat="), shown(code)),
    )
    return F.when(s.found, compared).otherwise(skipped(STATUS_ID, STATUS_SHORT))


def dwellings_agree(s: Subject) -> Column:
    """Number of dwellings within the tolerance of the reference's."""
    mine, known = s.record("anzahl_wohnungen"), s.reference("ganzwhg")
    difference = pct_diff(mine, known)
    passed = difference <= s.tolerance_pct
    compared = outcome(
        DWELLINGS_ID,
        DWELLINGS_NAME,
        passed,
        WARNING,
        _unless(passed, F.format_string(DWELLINGS_TEXT, shown(mine), shown(known), difference)),
        known,
        mine,
    )
    return (
        F.when(~s.found, skipped(DWELLINGS_ID, DWELLINGS_SHORT))
        .when(
            mine.isNull() | known.isNull(),
            skipped(DWELLINGS_ID, DWELLINGS_SHORT, NO_DWELLINGS_TEXT),
        )
        .otherwise(compared)
    )


CHECKS: dict[str, Callable[[Subject], Column]] = {
    "key_exists": key_exists,
    "address_matches": address_matches,
    "year_plausible": year_plausible,
    "status_fits_use": status_fits_use,
    "dwellings_agree": dwellings_agree,
}
