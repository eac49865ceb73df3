"""Bands, bins, ordinal codes and text labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Domain constants that readers of the outputs rely on.
MONTH_NUMBERS = {
    "JAN": 1, "FEV": 2, "MAR": 3, "ABR": 4, "MAI": 5, "JUN": 6,
    "JUL": 7, "AGO": 8, "SET": 9, "OUT": 10, "NOV": 11, "DEZ": 12,
}
AGE_BANDS = ("Jovem (<25)", "Adulto (25-59)", "Idoso (60+)")
AGE_BAND_UNDEFINED = "Indefinida"
AGE_BAND_EDGES = (25, 60)
REPORT_AGE_BANDS = ("a) <30", "b) 30-44", "c) 45-59", "d) 60+")
REPORT_AGE_BAND_EDGES = (30, 45, 60)
TENOR_BANDS = ("curto (até 12)", "médio (13-36)", "longo (37-60)", "muito longo (60+)")
TENOR_EDGES = (12, 36, 60)
ACTIVE_STATES = ("SP", "RJ", "RS", "SC", "PE")
RATE_BIN_EDGES = (0.8, 1.0, 1.2, 1.4, 1.6, 1.8, 2.0, 2.2, 2.5)
RATE_BIN_LABELS = ("0,8-1,0", "1,0-1,2", "1,2-1,4", "1,4-1,6", "1,6-1,8", "1,8-2,0", "2,0-2,2", "2,2-2,5")
BRANCH_NAME_NOISE = ("Agência ", "Agencia ")
WITHDRAWAL_TEXT = "saque"
APPROVED_STATUS = "Aprovado"
MONTHS_WITH_R = (1, 2, 3, 4, 9, 10, 11, 12)


def banded(
    value: Column,
    edges: Sequence[float],
    labels: Sequence[str],
    null_label: str | None = None,
    right_closed: bool = False,
) -> Column:
    """Label of the first edge above ``value`` (at or above it when right-closed); past the last edge, the last label.

    A null value gets ``null_label`` when one is given and otherwise falls into the last label, as an SQL ELSE does.
    """
    below = (lambda e: value <= e) if right_closed else (lambda e: value < e)
    chain = F.when(value.isNull(), F.lit(labels[-1] if null_label is None else null_label))
    for edge, label in zip(edges, labels):
        chain = chain.when(below(F.lit(edge)), F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def age_band(age: Column) -> Column:
    return banded(age, AGE_BAND_EDGES, AGE_BANDS, null_label=AGE_BAND_UNDEFINED)


def report_age_band(age: Column, null_label: str | None = None) -> Column:
    return banded(age, REPORT_AGE_BAND_EDGES, REPORT_AGE_BANDS, null_label=null_label)


def tenor_band(installments: Column) -> Column:
    return banded(installments, TENOR_EDGES, TENOR_BANDS, right_closed=True)


def mapped(col: Column, mapping: Mapping) -> Column:
    """Value of a literal map; unknown and null keys give null."""
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.element_at(F.create_map(*pairs), col)


def month_number(name: Column) -> Column:
    return mapped(F.upper(name), MONTH_NUMBERS)


def ordinal(col: Column, labels: Sequence[str], default: int | None = None) -> Column:
    """Position in a fixed list."""
    index = mapped(col, {label: i for i, label in enumerate(labels)})
    return index if default is None else F.coalesce(index, F.lit(default))


def age_band_index(band: Column) -> Column:
    return ordinal(band, AGE_BANDS, default=len(AGE_BANDS))


def status_code(status: Column) -> Column:
    """Free-text status to code; the first matching rule wins, no match and null give 0."""
    text = F.lower(status)
    # The substrings and the codes.
    return (
        F.when(text.contains("aprov"), 1)
        .when(text.contains("valid"), 2)
        .when(text.contains("an") & F.translate(text, "á", "a").contains("lise"), 3)
        .otherwise(0)
    )


def bin_index(value: Column, edges: Sequence[float], clamp_to_zero: bool = False) -> Column:
    """Right-closed bins whose first bin also holds the lowest edge; outside and null give null (or bin 0)."""
    chain = F.when(value < edges[0], None)
    for i, upper in enumerate(edges[1:]):
        chain = chain.when(value <= upper, i)
    return F.coalesce(chain, F.lit(0)) if clamp_to_zero else chain


def without(col: Column, pieces: Sequence[str]) -> Column:
    """Literal pieces removed, then white space at both ends."""
    for piece in pieces:
        col = F.replace(col, F.lit(piece), F.lit(""))
    return F.trim(col, F.lit(" \t\r\n"))


def last_part(col: Column, separator: str, trimmed: bool = False) -> Column:
    """Text after the last separator, the whole text without one; an untrimmed result keeps a leading blank."""
    part = F.split_part(col, F.lit(separator), F.lit(-1))
    return F.trim(part) if trimmed else part


def contains_text(col: Column, text: str) -> Column:
    """Case-insensitive substring; null counts as no match."""
    return F.coalesce(col.ilike(f"%{text}%"), F.lit(False))


def full_name(first: Column, last: Column) -> Column:
    """Null as soon as one part is null."""
    return F.concat(first, F.lit(" "), last)
