"""Bronze -> silver: canonical names, types, derived columns, first row per key.

Each function takes text columns under their raw names. ``order`` names the columns that give the row order; bronze
tables carry them as lineage. Dates are read in the layout that most values of their column have, amounts get the decimal
type that holds all of their column (``dates`` and ``money`` give layouts and types where they are known). A row whose key does not parse is
left out, as bronze sets it aside; a reference that does not parse is null.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import calendar, casting, labels, layouts
from ..operators.dedup import keep_first, keep_first_of_few
from ..sources.delimited import ROW_ORDER
from ..sources.layers import without_lineage
from ..sources.tables import BY_NAME

AS_OF = "2024-01-01"   # fixed value: reference date of the decimal age

#: How each typed column is read.
KEY, TEXT_KEY, DATE, TIMESTAMP, MIXED, MONEY, RATE, INT, SMALL_KEY = (
    "key", "text key", "date", "timestamp", "timestamp in any layout", "money", "rate", "int", "int key"
)
TYPED: dict[str, dict[str, str]] = {
    "branches": {"branch_id": KEY, "opened_on": DATE},
    "clients": {"client_id": KEY, "birth_date": DATE, "joined_at": TIMESTAMP},
    "accounts": {
        "account_id": TEXT_KEY, "client_id": KEY, "branch_id": KEY, "balance": MONEY, "available_balance": MONEY, "opened_on": DATE,
    },
    "transactions": {"tx_id": KEY, "account_id": TEXT_KEY, "tx_at": MIXED, "amount": MONEY},
    "proposals": {
        "proposal_id": KEY, "client_id": KEY, "employee_id": KEY, "submitted_at": TIMESTAMP, "monthly_rate": RATE,
        "proposed_amount": MONEY, "financed_amount": MONEY, "down_payment": MONEY, "installment_amount": MONEY,
        "installments": INT, "grace_months": INT,
    },
    "employees": {"employee_id": KEY, "birth_date": DATE},
    "employee_branch": {"employee_id": KEY, "branch_id": KEY},
    "price_index": {
        "year": SMALL_KEY, **{c: RATE for c in ("index_level", "month_pct", "pct_3m", "pct_6m", "pct_ytd", "pct_12m")}
    },
}
_CASTS: dict[str, Callable[[Column], Column]] = {
    KEY: casting.try_key,
    SMALL_KEY: lambda c: casting.try_key(c, "int"),
    TEXT_KEY: lambda c: casting.try_key(c, "string"),
    MIXED: casting.to_utc_timestamp_mixed,
    RATE: casting.to_rate,
    INT: casting.to_int,
}


def money_columns(table: str) -> dict[str, str]:
    """Raw names of a table's amounts and their canonical names."""
    kinds = TYPED[table]
    return {raw: name for raw, name in BY_NAME[table].renames().items() if kinds.get(name) == MONEY}


def date_columns(table: str) -> dict[str, tuple[str, str]]:
    """Raw names of a table's dates and times with one layout, each with its canonical name and kind."""
    kinds = TYPED[table]
    return {raw: (name, kinds[name]) for raw, name in BY_NAME[table].renames().items() if kinds.get(name) in (DATE, TIMESTAMP)}


def _renamed(raw: DataFrame, table: str) -> DataFrame:
    """Raw names to canonical names; optional columns the file lacks become nulls, extra columns stay as they came.

    Text that marks a missing value becomes null; in typed columns the casts do that.
    """
    definition = BY_NAME[table]
    renames = definition.renames()
    absent = [f.name for r, f in zip(renames, definition.fields) if r not in raw.columns and f.optional]
    result = raw.withColumnsRenamed({r: n for r, n in renames.items() if r in raw.columns})
    texts = [f.name for f in definition.fields if f.type == "string" and f.name in result.columns]
    return result.withColumns({
        **{n: F.lit(None).cast("string") for n in absent}, **{n: casting.missing_to_null(F.col(n)) for n in texts}
    })


def _readable(text: DataFrame, table: str) -> DataFrame:
    """Rows whose key is missing or parses."""
    key = BY_NAME[table].key
    return text if key is None else text.filter(~casting.is_bad_key(F.col(key), _key_type(table)))


def _key_type(table: str) -> str:
    return next(f.type for f in BY_NAME[table].fields if f.name == BY_NAME[table].key)


def _typed(text: DataFrame, table: str, money: Mapping[str, str] | None, dates: Mapping[str, int] | None = None) -> DataFrame:
    kinds = {name: kind for name, kind in TYPED[table].items() if name in text.columns}
    amounts = [name for name, kind in kinds.items() if kind == MONEY]
    types = layouts.money_types(text, amounts) if money is None else {a: money.get(a, casting.MONEY) for a in amounts}
    df = layouts.dated(text, {name: kind for name, kind in kinds.items() if kind in (DATE, TIMESTAMP)}, dates)
    plain = {name: _CASTS[kind](F.col(name)) for name, kind in kinds.items() if kind in _CASTS}
    return df.withColumns({**plain, **{name: F.col(name).try_cast(kind) for name, kind in types.items()}})


def _cleaned(
    raw: DataFrame, table: str, money: Mapping[str, str] | None = None, dates: Mapping[str, int] | None = None
) -> DataFrame:
    return _typed(_readable(_renamed(raw, table), table), table, money, dates)


def lost_values(raw: DataFrame, table: str, money: Mapping[str, str] | None = None) -> DataFrame:
    """``table, column, lost``: values that are there but cannot be read, for each typed column. Rows with a key that cannot
    be read count under the key alone."""
    text = _renamed(raw, table)
    names = [n for n in TYPED[table] if n in text.columns]
    key = BY_NAME[table].key
    kept = _readable(text, table).withColumns({f"_text_{n}": F.col(n) for n in names})
    lost = [
        F.count_if(casting.missing_to_null(F.trim(f"_text_{n}")).isNotNull() & F.col(n).isNull()).alias(n) for n in names if n != key
    ]
    parts = [_typed(kept, table, money).agg(*lost)] if lost else []
    if key is not None:
        parts.append(text.agg(F.count_if(casting.is_bad_key(F.col(key), _key_type(table))).alias(key)))
    rows = [
        part.select(F.explode(F.array(*[
            F.struct(F.lit(table).alias("table"), F.lit(c).alias("column"), F.col(c).alias("lost")) for c in part.columns
        ])).alias("x")).select("x.*") for part in parts
    ]
    return reduce(DataFrame.unionByName, rows)


def _unique(df: DataFrame, table: str, order: Sequence[str]) -> DataFrame:
    return without_lineage(keep_first(df, [BY_NAME[table].key], order))


def branches(raw: DataFrame, order: Sequence[str] = ROW_ORDER, dates: Mapping[str, int] | None = None) -> DataFrame:
    df = _cleaned(raw, "branches", dates=dates)
    df = df.withColumn("short_name", labels.without(F.col("branch_name"), labels.BRANCH_NAME_NOISE))
    return _unique(df, "branches", order)


def clients(
    raw: DataFrame, order: Sequence[str] = ROW_ORDER, as_of: str = AS_OF, dates: Mapping[str, int] | None = None
) -> DataFrame:
    df = _cleaned(raw, "clients", dates=dates).withColumn("age_years", calendar.decimal_age(F.col("birth_date"), as_of))
    return _unique(df.withColumn("age_band", labels.age_band(F.col("age_years"))), "clients", order)


def accounts(
    raw: DataFrame, order: Sequence[str] = ROW_ORDER, money: Mapping[str, str] | None = None, dates: Mapping[str, int] | None = None
) -> DataFrame:
    """Keeps the file position as ``file_order``: a client's primary account is the first one in the file."""
    return _unique(_cleaned(raw, "accounts", money, dates).withColumn("file_order", F.struct(*order)), "accounts", order)


def transactions(raw: DataFrame, order: Sequence[str] = ROW_ORDER, money: Mapping[str, str] | None = None) -> DataFrame:
    kept = _unique(_cleaned(raw, "transactions", money).dropna(subset=["tx_at"]), "transactions", order)
    return kept.withColumns({
        "amount_abs": F.abs("amount"),
        "year": calendar.year(F.col("tx_at")),
        "month": calendar.month(F.col("tx_at")),
        "weekday": calendar.weekday(F.col("tx_at")),
    })


def proposals(
    raw: DataFrame, order: Sequence[str] = ROW_ORDER, money: Mapping[str, str] | None = None, dates: Mapping[str, int] | None = None
) -> DataFrame:
    df = _cleaned(raw, "proposals", money, dates).withColumn("year", F.coalesce(calendar.year(F.col("submitted_at")), F.lit(0)))
    # the widest rows of all tables
    return without_lineage(keep_first_of_few(df, BY_NAME["proposals"].key, order))


def employees(raw: DataFrame, order: Sequence[str] = ROW_ORDER, dates: Mapping[str, int] | None = None) -> DataFrame:
    return _unique(_cleaned(raw, "employees", dates=dates), "employees", order)


def employee_branch(raw: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """Distinct pairs, each with the position of its first row: the last branch of an employee wins later on."""
    df = _cleaned(raw, "employee_branch")
    pair = [c for c in df.columns if not c.startswith("_") and c not in order]
    return df.groupBy(*pair).agg(F.min(F.struct(*order)).alias("file_order"))


def price_index(raw: DataFrame) -> DataFrame:
    df = _cleaned(raw, "price_index").withColumn("month", labels.month_number(F.col("month_name")))
    return without_lineage(df.dropna(subset=["month"]))


def index_series(price_index: DataFrame) -> DataFrame:
    """Monthly index as fractions with the first day of the month, the form the analyses use."""
    fraction = lambda c: (F.col(c).try_cast("decimal(10,4)") / 100).cast("decimal(10,6)")
    return price_index.select(
        F.make_date("year", "month", F.lit(1)).alias("month_start"),
        fraction("month_pct").alias("month_rate"),
        fraction("pct_12m").alias("rate_12m"),
    )


TRANSFORMS: dict[str, Callable[..., DataFrame]] = {
    "branches": branches,
    "clients": clients,
    "accounts": accounts,
    "transactions": transactions,
    "proposals": proposals,
    "employees": employees,
    "employee_branch": employee_branch,
    "price_index": price_index,
}
