"""What a whole text column says about its type: the layout most of its dates have, the digits its numbers need.

Both are one aggregate over the column. A layout that is not known yet is found inside the query that uses it; the digits
set a column's type, so they are known before the plan is made.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Day layouts beside the ISO family, in the order that settles equal votes, and the shape of their texts.
_YEAR_FIRST, _PACKED = r"^\d{4}/\d{1,2}/\d{1,2}(?: |$)", r"^\d{8}(?: |$)"
DAY_LAYOUTS = {
    "yyyy/M/d": _YEAR_FIRST,
    "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}(?: |$)", "d/M/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}(?: |$)",
    "M-d-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}(?: |$)", "d-M-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}(?: |$)",
    "M.d.yyyy": r"^\d{1,2}\.\d{1,2}\.\d{4}(?: |$)", "d.M.yyyy": r"^\d{1,2}\.\d{1,2}\.\d{4}(?: |$)",
    "yyyyMMdd": _PACKED,
}
TIME = "[ H:mm[:ss]]"

#: Decimal digits that a type can have, and those of a plain amount.
MOST_DIGITS, PLAIN_DIGITS, PLAIN_PLACES = 38, 14, 2


def _readings(text: Column, kind: str) -> list[Column]:
    """The value in each layout, ISO first; null where the text has another one.

    A text is parsed only in layouts whose shape it has, as a failed attempt costs far more than a look at the shape.
    """
    # marks of missing values have no layout at all
    value = F.trim(text)
    readings = [value.try_cast(kind)]
    for day, shape in DAY_LAYOUTS.items():
        readings.append(F.when(value.rlike(shape), F.try_to_timestamp(value, F.lit(day + TIME)).cast(kind)))
    return readings


def _dashed(text: Column) -> Column:
    """Dashes where ISO texts have them: such a text has the shape of no other layout."""
    value = F.trim(text)
    return (F.substr(value, F.lit(5), F.lit(1)) == "-") & (F.substr(value, F.lit(8), F.lit(1)) == "-")


def votes(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row with a column for each text column (name -> date or timestamp): the number of its layout.

    The layout that most values have wins, the first of equal ones; a column without any date counts as ISO.
    """
    counts = df.agg(*[_counts(F.col(f"`{name}`"), kind).alias(name) for name, kind in columns.items()])
    return counts.select(*[_most(F.col(f"`{n}`")).cast("int").alias(n) for n in columns])


def _counts(text: Column, kind: str, where: Column | None = None) -> Column:
    iso, *others = _readings(text, kind)
    taken = F.lit(True) if where is None else where
    # what all counts ask first is computed once
    other = ~_dashed(text)
    return F.array(F.count_if(taken & iso.isNotNull()), *[F.count_if(other & taken & reading.isNotNull()) for reading in others])


def _most(counts: Column) -> Column:
    return F.array_position(counts, F.array_max(counts)) - 1


def layout_measures(columns: Mapping[str, str], where: Column) -> dict[str, Column]:
    """Aggregates ``layout:<column>``, the number that :func:`votes` finds in the rows for which ``where`` is true."""
    return {f"layout:{name}": _most(_counts(F.col(f"`{name}`"), kind, where)) for name, kind in columns.items()}


def in_layout(text: Column, kind: str, layout: Column) -> Column:
    """The value in the column's layout; null in any other one."""
    first, *others = _readings(text, kind)
    result = F.when(layout == 0, first)
    for k, reading in enumerate(others, 1):
        result = result.when(layout == k, reading)
    return result


def dated(df: DataFrame, columns: Mapping[str, str], known: Mapping[str, int] | None = None) -> DataFrame:
    """``df`` with text columns as dates or timestamps in the layout of the whole column: the ``known`` number of it (ISO
    where it has none), or found by a scalar subquery."""
    if not columns:
        return df
    if known is not None:
        return df.withColumns({n: _readings(F.col(f"`{n}`"), kind)[known.get(n, 0)] for n, kind in columns.items()})
    layout = votes(df, columns).select(F.struct(*[f"`{n}`" for n in columns]).alias("layouts")).scalar()
    return df.withColumns({n: in_layout(F.col(f"`{n}`"), kind, layout.getField(n)) for n, kind in columns.items()})


# --- digits ----------------------------------------------------------------------------------------------------

NUMBER = r"^\s*[+-]?(\d*)(?:\.(\d*))?(?:[eE]([+-]?\d{1,4}))?\s*$"


def digit_measures(columns: Iterable[str]) -> dict[str, Column]:
    """Aggregates ``digits:<column>`` and ``places:<column>``: no number has more digits before and after the point.

    Signs and zeros at the ends may count, which makes a type wider than it need be; text that is no number does not count.
    """
    measures = {}
    for name in columns:
        text = F.trim(f"`{name}`")
        part = lambda k: F.regexp_extract(text, NUMBER, k)  # noqa: B023, E731
        shift = F.coalesce(part(3).try_cast("int"), F.lit(0))
        scientific = F.lower(text).contains("e")
        plain_digits = F.length(F.substring_index(text, ".", 1))
        digits = F.when(scientific, F.greatest(F.length(part(1)) + shift, F.lit(0))).otherwise(plain_digits)
        places = F.when(scientific, F.greatest(F.length(part(2)) - shift, F.lit(0))).when(
            text.contains("."), F.length(text) - plain_digits - 1
        ).otherwise(0)
        is_number = text.try_cast("double").isNotNull()
        for kind, count in (("digits", digits), ("places", places)):
            measures[f"{kind}:{name}"] = F.coalesce(F.max(F.when(is_number, count)), F.lit(0)).cast("bigint")
    return measures


def decimal_type(digits: int, places: int) -> str:
    """A decimal that holds every value of a column: a plain amount's type where that does, otherwise no narrower one.

    With more than 38 digits in all, places are given up before digits; a number too large even then becomes null, and is
    counted with the lost values.
    """
    places = max(places, PLAIN_PLACES)
    digits = max(digits, PLAIN_DIGITS - PLAIN_PLACES)
    if digits + places > MOST_DIGITS:
        digits = min(digits, MOST_DIGITS - PLAIN_PLACES)
        places = MOST_DIGITS - digits
    return f"decimal({digits + places},{places})"


def money_types(df: DataFrame, columns: Iterable[str]) -> dict[str, str]:
    """The decimal type of each text column; reads the columns once."""
    columns = list(columns)
    if not columns:
        return {}
    found = df.agg(*[measure.alias(name) for name, measure in digit_measures(columns).items()]).first().asDict()
    return {c: decimal_type(found[f"digits:{c}"], found[f"places:{c}"]) for c in columns}
