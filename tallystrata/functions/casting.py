"""Typing of raw text columns. Values that do not parse become null, except keys, which fail loudly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MONEY = "decimal(14,2)"

# Text that the delimited-file reader treats as missing.
MISSING_MARKS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Timestamp spellings tried, in this order, after the ISO family.
EXTRA_TIMESTAMP_FORMATS = (
    "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd",
    "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy",
    "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy",
    "yyyyMMdd",
)


def missing_to_null(col: Column) -> Column:
    # one literal in place of many: plans of wide tables are built faster
    return F.when(F.find_in_set(col, F.lit(",".join(MISSING_MARKS))) == 0, col)


def to_money(col: Column) -> Column:
    return col.try_cast(MONEY)


def to_rate(col: Column) -> Column:
    """Rates stay binary doubles: histogram edges are compared after scaling by 100 in doubles."""
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_int(col: Column) -> Column:
    # through decimal, so that "12.0" counts as 12
    return F.coalesce(col.try_cast("int"), col.try_cast("decimal(20,4)").try_cast("int"))


def to_date(col: Column) -> Column:
    return col.try_cast("date")


def to_utc_timestamp(col: Column) -> Column:
    """ISO family only: offsets are honoured, text without an offset is UTC (session zone UTC)."""
    return col.try_cast("timestamp")


def to_utc_timestamp_mixed(col: Column, formats: tuple[str, ...] = EXTRA_TIMESTAMP_FORMATS) -> Column:
    tries = [F.try_to_timestamp(col, F.lit(f)) for f in formats]
    return F.coalesce(to_utc_timestamp(col), *tries)


def to_key(col: Column, kind: str = "bigint") -> Column:
    """A key that must parse, or the query stops. "12.0" counts as 12."""
    text = missing_to_null(F.trim(col))
    if kind == "string":
        return text
    return F.coalesce(text.try_cast(kind), _without_point(text).cast(kind))


def _without_point(text: Column) -> Column:
    return F.regexp_replace(text, r"\.0+$", "")


def try_key(col: Column, kind: str = "bigint") -> Column:
    """A key, null where it is missing or does not parse. A cast skips blanks, and no mark of a missing value is a number."""
    text = F.trim(col)
    return missing_to_null(text) if kind == "string" else F.coalesce(col.try_cast(kind), _without_point(text).try_cast(kind))


def is_bad_key(col: Column, kind: str = "bigint") -> Column:
    """Whether there is a key that does not parse. Such rows are set aside: as null keys they would merge."""
    if kind == "string":
        return F.lit(False)
    # nearly all keys are plain numbers, and need no second look
    text = F.trim(col)
    return col.try_cast(kind).isNull() & missing_to_null(text).isNotNull() & _without_point(text).try_cast(kind).isNull()


def optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column when the table has it, otherwise a typed null."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(kind)
