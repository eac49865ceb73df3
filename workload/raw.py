"""Raw delimited files written from the driver's tables, and the batch job over them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallystrata.functions import calendar, numeric
from tallystrata.plans import job as batch, load, quality, silver
from tallystrata.plans.report import BY_SECTION, ROW_SECTIONS, SECTIONS
from tallystrata.sources.delimited import CORRUPT, REASON, read_raw, read_typed
from tallystrata.sources.layers import Lake
from tallystrata.sources.report_store import section_sizes, section_values
from tallystrata.sources.scratch import scratch_path, stored
from tallystrata.sources.tables import BY_NAME

from .bank import Bank

#: Rows of a compressed raw file, which one task reads.
FILE_ROWS = 1_000_000
#: The files are read a few times and then gone: a fast level, with files an eighth larger than at the usual one.
RAW_FILES = {"compression": "gzip", "zlib.compress.level": "TWO", "maxRecordsPerFile": FILE_ROWS}

MONTHS = ("JAN", "FEV", "MAR", "ABR", "MAI", "JUN", "JUL", "AGO", "SET", "OUT", "NOV", "DEZ")


def timestamp_text(at: Column) -> Column:
    """Seven spellings by day of the month; day 31 is no date at all."""
    spelled = lambda pattern: F.date_format(at, pattern)
    day = F.dayofmonth(at)
    behind = F.date_format(at - F.expr("interval 3 hours"), "yyyy-MM-dd HH:mm:ss")
    return (
        F.when(day == 31, F.lit("sem data"))
        .when(day % 6 == 0, F.concat(spelled("yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))
        .when(day % 6 == 1, spelled("yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(day % 6 == 2, spelled("yyyy-MM-dd HH:mm:ss.SSS"))
        .when(day % 6 == 3, F.concat(behind, F.lit("-03:00")))
        .when(day % 6 == 4, spelled("yyyy-MM-dd"))
        .otherwise(spelled("yyyy/MM/dd HH:mm:ss"))
    )


def _choice(col: Column, pairs: dict[str, str]) -> Column:
    result = F.when(F.lit(False), F.lit(""))
    for value, text in pairs.items():
        result = result.when(col == value, F.lit(text))
    return result


def raw_frames(b: Bank) -> dict[str, Callable[[], DataFrame]]:
    """Makers of the eight sources as text, columns in the order of their raw header."""
    state = _choice(F.col("state"), {"AFRICA": "SP", "AMERICA": "RJ", "ASIA": "RS", "EUROPE": "SC", "MIDDLE EAST": "MG"})
    kind = _choice(F.col("tx_type"), {
        "1-URGENT": "Compra Crédito", "2-HIGH": "Pix", "3-MEDIUM": "Boleto Pago", "4-NOT SPECIFIED": "Depósito",
        "5-LOW": "Saque Eletrônico",
    })
    day = lambda c: F.date_format(c, "yyyy-MM-dd")

    def transactions() -> DataFrame:
        # the first of every month comes in twice: exact copies
        tx = b.transactions()
        return tx.unionByName(tx.filter(F.dayofmonth("tx_at") == 1)).select(
            "tx_id", "account_id", timestamp_text(F.col("tx_at")), kind, "amount"
        )

    def price_index() -> DataFrame:
        index, at = b.index().withColumn("pct", F.col("month_rate") * 100), F.col("month_start")
        return index.select(
            calendar.year(at), F.element_at(F.array(*map(F.lit, MONTHS)), calendar.month(at)), F.lit("100.0"),
            F.round("pct", 2), F.lit("0"), F.lit("0"), F.lit("0"), F.round(F.col("pct") * 12, 2),
        )

    makers = {
        "branches": lambda: b.branches().select(
            "branch_id", F.concat(F.lit("Agência "), "short_name"), F.concat(F.lit("Rua, "), "branch_id", F.lit(" - Sé")),
            "branch_name", state, F.lit("2010-01-01"), "branch_kind",
        ),
        "clients": lambda: b.clients().select(
            "client_id", "first_name", "last_name", F.concat("last_name", F.lit("@example.org")), F.lit("PF"),
            day("birth_date"), F.lit("000"), F.lit("Rua A / SP"), F.lit("01310-916"),
            F.concat(day("joined_at"), F.lit(" 10:00:00 UTC")),
        ),
        "employees": lambda: b.employees().select(
            "employee_id", "first_name", "last_name", F.lit("x@example.org"), F.lit("000"), F.lit("1980-02-29"),
            F.lit("Rua B / RJ"), F.lit("20000-000"),
        ),
        "employee_branch": lambda: b.employee_branch().select("employee_id", "branch_id"),
        "accounts": lambda: b.accounts().select(
            "account_id", "client_id", "branch_id", F.lit("PF"), F.lit("2015-05-05"), "balance", "balance"
        ),
        "proposals": lambda: b.proposals(with_client=True).select(
            F.shiftrightunsigned("proposal_id", 1), "client_id", "employee_id", timestamp_text(F.col("submitted_at")),
            "monthly_rate", "proposed_amount", "financed_amount", "down_payment", F.lit("1.00"), "installments",
            F.lit(0), "status",
        ),
        "transactions": transactions,
        "price_index": price_index,
    }
    return {name: lambda n=name, make=make: _text(make(), n) for name, make in makers.items()}


def _text(frame: DataFrame, table: str) -> DataFrame:
    names = [r for r in BY_NAME[table].renames()][: len(frame.columns)]
    strings = frame.toDF(*names)
    return strings.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names])


def write_raw(b: Bank, root: str, tables: tuple[str, ...] | None = None) -> str:
    for name, make in raw_frames(b).items():
        if tables is None or name in tables:
            frame = make()
            header = [f.raw for f in BY_NAME[name].fields][: len(frame.columns)]
            write_csv(frame, f"{root}/{BY_NAME[name].file}", header, **RAW_FILES)
    return root


def write_csv(frame: DataFrame, path: str, header: list[str], **options: object) -> None:
    """CSV with the given header texts, which may repeat."""
    if len(set(header)) == len(header):
        frame.toDF(*header).write.options(**options).option("header", True).option("escape", '"').csv(path)
        return
    # a repeated header cannot be a schema; such a table is small, so its header row is sorted in front
    lines = frame.select(F.lit(1).alias("at"), F.concat_ws(",", *[F.col(f"`{c}`") for c in frame.columns]).alias("value"))
    top = frame.sparkSession.createDataFrame([(0, ",".join(header))], "at int, value string")
    top.unionByName(lines).coalesce(1).sortWithinPartitions("at", "value").select("value").write.text(path)


def bronze_transactions(b: Bank) -> DataFrame:
    lake = bronze(b, "transactions")
    rows = lake.bronze("transactions", row_index=True)
    per_file = rows.groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("n"), F.max("_row_idx").alias("last"), F.min("_row_idx").alias("first"),
        F.sum("_row_idx").alias("total"),
    )
    ordinal_sum = F.sum(F.col("n") * (F.col("n") - 1) / 2).cast("bigint")
    return per_file.agg(
        F.sum("n").alias("rows"), F.sum(F.col("last") + 1).cast("bigint").alias("last_positions"),
        F.max("first").cast("bigint").alias("first_position"), (F.sum("total") - ordinal_sum).cast("bigint").alias("ordinal_gap"),
    ).withColumn("rejected", lake.rejects("transactions").agg(F.count(F.lit(1)).alias("n")).scalar())


def bronze(b: Bank, table: str) -> Lake:
    """One table written as raw text and ingested."""
    root = write_raw(b, scratch_path(b.spark, "raw"), (table,))
    lake = Lake(b.spark, scratch_path(b.spark, "lake"))
    lake.write(read_raw(b.spark, f"{root}/{BY_NAME[table].file}"), "bronze", table)
    return lake


def line_breaks(b: Bank) -> DataFrame:
    """Orders in one file whose type text spans lines, read back."""
    text = F.concat(F.col("o_orderpriority"), F.lit(',\n"'), F.col("o_orderkey").cast("string"), F.lit('"\n\nend'))
    note = F.when(F.col("o_orderkey") % 3 == 0, text).otherwise(F.col("o_orderpriority"))
    frame = b.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", note.alias("note"), "o_totalprice")
    path = f"{scratch_path(b.spark, 'raw')}/{BY_NAME['transactions'].file}"
    write_csv(_text(frame, "transactions").coalesce(1), path, [f.raw for f in BY_NAME["transactions"].fields])
    rows = read_raw(b.spark, path, table=BY_NAME["transactions"], short_rows="reject").filter("not _rejected")
    return rows.select(
        F.col("cod_transacao").cast("bigint").alias("tx_id"), F.col("nome_transacao").alias("tx_type"),
        F.col("valor_transacao").cast("double").alias("amount"),
    )


def rejects(b: Bank) -> DataFrame:
    """Rows taken and set aside by reason, with the sum of their order keys, of orders with planted faults."""
    key = F.col("o_orderkey").cast("string")
    rest = ("o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    fields = F.concat_ws(",", *[F.col(c).cast("string") for c in rest])
    line = (
        F.when(F.col("o_orderkey") % 11 == 0, F.concat(key, F.lit(",short")))
        .when(F.col("o_orderkey") % 13 == 0, F.concat(key, F.lit(","), fields, F.lit(",more")))
        .when(F.col("o_orderkey") % 17 == 0, F.concat(key, F.lit(',"'), fields))
        .when(F.col("o_orderkey") % 19 == 0, F.concat(key, F.lit("x,"), fields))
        .when(F.col("o_orderkey") % 23 == 0, F.concat(key, F.lit(',"1","2020-01-01","two\nlines","5"')))
        .otherwise(F.concat(key, F.lit(","), fields))
    )
    path = f"{scratch_path(b.spark, 'raw')}/{BY_NAME['transactions'].file}"
    top = F.lit(",".join(f.raw for f in BY_NAME["transactions"].fields))
    header = b.spark.range(1).select(F.lit(-1).cast("bigint").alias("at"), top.alias("value"))
    lines = header.unionByName(b.table("orders").select(F.col("o_orderkey").alias("at"), line.alias("value")))
    # a file for each range of keys; the first one has the header row, each later one gets its own
    at_top = (F.spark_partition_id() > 0) & (F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)) == 0)
    ranged = lines.repartitionByRange("at").sortWithinPartitions("at").select(
        F.explode(F.when(at_top, F.array(top, F.col("value"))).otherwise(F.array("value"))).alias("value")
    )
    ranged.write.text(path)
    rows = read_raw(b.spark, path, table=BY_NAME["transactions"], short_rows="reject")
    first = F.coalesce(F.col(CORRUPT), F.col("cod_transacao"))
    return rows.groupBy(F.coalesce(F.col(REASON), F.lit("taken")).alias("reason")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.regexp_extract(first, r"^(\d+)", 1).cast("bigint")).alias("keys")
    )


def mixed_encodings(b: Bank) -> DataFrame:
    """Customers with accented names, a third each in UTF-8, in UTF-8 with a byte order mark, and in Latin-1."""
    root = f"{scratch_path(b.spark, 'raw')}/colaboradores.csv"
    name = F.concat(F.lit("João Ñ "), F.col("c_name"))
    people = b.table("customer").select(F.col("c_custkey").cast("string").alias("cod_colaborador"), name.alias("primeiro_nome"), (F.col("c_custkey") % 3).alias("k"))
    part = lambda k: people.filter(F.col("k") == k).drop("k")
    part(0).write.option("header", True).csv(f"{root}/as=utf8")
    part(1).write.option("header", True).option("encoding", "ISO-8859-1").csv(f"{root}/as=latin1")
    marked = part(2).select(F.lit(1).alias("at"), F.concat_ws(",", "cod_colaborador", "primeiro_nome").alias("value"))
    top = b.spark.createDataFrame([(0, "\ufeffcod_colaborador,primeiro_nome")], "at int, value string")
    top.unionByName(marked).coalesce(1).sortWithinPartitions("at").select("value").write.text(f"{root}/as=marked")
    rows = read_raw(b.spark, root).filter("not _rejected")
    return rows.select(
        F.col("cod_colaborador").cast("bigint").alias("employee_id"), F.col("primeiro_nome").alias("first_name"),
        F.split_part("_source_file", F.lit("/"), F.lit(1)).alias("folder"),
    )


def spelled_dates(b: Bank) -> DataFrame:
    """Birth dates of customers as text: day first, year first with slashes, and a fourth of them in another layout than the rest."""
    spelled = lambda layout: F.date_format("birth_date", layout)
    return b.clients().select(
        "client_id", spelled("dd/MM/yyyy").alias("day_first"), spelled("yyyy/MM/dd").alias("year_first"),
        F.when(F.col("client_id") % 4 == 0, spelled("dd/MM/yyyy")).otherwise(spelled("yyyy-MM-dd")).alias("mixed"),
    )


def lost_dates(b: Bank) -> DataFrame:
    """Values of raw clients that cannot be read, by column: the birth dates have two layouts, the keys some letters."""
    key = F.when(F.col("client_id") % 10 == 0, F.concat(F.lit("k"), F.col("client_id"))).otherwise(F.col("client_id").cast("string"))
    clients = spelled_dates(b).select(
        key.alias("cod_cliente"), F.col("mixed").alias("data_nascimento"), F.lit("2020-01-01 10:00:00").alias("data_inclusao")
    )
    return silver.lost_values(clients, "clients")


def wide_amounts(b: Bank) -> DataFrame:
    """Silver accounts with balances of sixteen digits and four places, and their exact total."""
    key = F.col("o_orderkey")
    text = F.concat((F.lit(10**15) + key).cast("string"), F.lit("."), F.lpad((key % 10000).cast("string"), 4, "0"))
    raw = b.table("orders").select(
        key.cast("string").alias("num_conta"), F.col("o_custkey").cast("string").alias("cod_cliente"), F.lit("1").alias("cod_agencia"),
        F.when(key % 2 == 0, F.concat(F.lit("-"), text)).otherwise(text).alias("saldo_total"),
        F.lit("2015-05-05").alias("data_abertura"), key.alias("_pos"),
    )
    accounts = stored(silver.accounts(raw, ("_pos",)), "wide")
    total = accounts.agg(numeric.exact_sum(F.col("balance")).cast("string").alias("t")).scalar()
    return accounts.select("account_id", F.col("balance").cast("string").alias("balance"), total.alias("total"))


def checked(b: Bank) -> DataFrame:
    """The checks on a whole lake, and on one that never got to its last layer."""
    def results(name: str, lake: Lake) -> DataFrame:
        measures = lake.measures().unionByName(quality.key_measures(lake))
        told = quality.check_results(b.spark, measures)
        known = F.filter(F.map_values("measures"), lambda v: v.isNotNull())
        total = F.aggregate(known, F.lit(0).cast("bigint"), lambda x, y: x + y)
        return told.select(F.lit(name).alias("lake"), "name", "passed", F.size("measures").alias("measures"), total.alias("total"))

    root = write_raw(b, scratch_path(b.spark, "raw"))
    whole = job(b, root)
    half = Lake(b.spark, scratch_path(b.spark, "lake"))
    batch.run(b.spark, root, half.root, ["bronze", "silver"])
    return results("whole", whole).unionByName(results("half", half))


def silver_table(b: Bank, table: str, *dropped: str) -> DataFrame:
    """The silver table of one raw source, with decimals as doubles and timestamps without a zone."""
    rows = silver.TRANSFORMS[table](bronze(b, table).bronze(table)).drop(*dropped)

    def shown(name: str, kind: str):
        if kind.startswith("decimal") or kind == "double":
            return numeric.as_double(F.col(name)).alias(name)
        return F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
    return rows.select(*[shown(name, kind) for name, kind in rows.dtypes])


def typed_transactions(b: Bank) -> DataFrame:
    """Bulk load of clean text into the declared types."""
    table = BY_NAME["transactions"]
    text = _text(b.transactions().withColumn("tx_at", F.date_format("tx_at", "yyyy-MM-dd HH:mm:ss")), "transactions")
    path = f"{scratch_path(b.spark, 'typed')}/{table.file}"
    write_csv(text, path, [f.raw for f in table.fields])
    return read_typed(b.spark, path, table).select(
        "tx_id", "account_id", F.col("tx_at").cast("timestamp_ntz").alias("tx_at"), "tx_type",
        numeric.as_double(F.col("amount")).alias("amount"),
    )


def typed_tables(b: Bank) -> DataFrame:
    """Row counts of a bulk load of seven tables from clean text."""
    root, at = scratch_path(b.spark, "typed"), "yyyy-MM-dd HH:mm:ss"
    frames = raw_frames(b)
    clean = {
        "transactions": lambda: _text(b.transactions().withColumn("tx_at", F.date_format("tx_at", at)), "transactions"),
        "proposals": lambda: frames["proposals"]().withColumns({
            "data_entrada_proposta": F.lit("2020-01-01 10:00:00"), "taxa_juros_mensal": F.lit("0.0150"),
        }),
        "clients": lambda: frames["clients"]().withColumn("data_inclusao", F.lit("2020-01-01 10:00:00")),
        "index_series": lambda: b.index().select(
            F.col("month_start").cast("string"), F.col("month_rate").cast("string"), F.lit("0.0419")
        ),
    }
    for table in load.LOADED:
        frame = clean.get(table.name, frames.get(table.name))()
        write_csv(frame, f"{root}/{table.file}", [f.raw for f in table.fields][: len(frame.columns)])
    return load.load_counts(load.load(b.spark, root, scratch_path(b.spark, "lake")))


def job(b: Bank, root: str | None = None) -> Lake:
    root = root or write_raw(b, scratch_path(b.spark, "raw"))
    lake = Lake(b.spark, scratch_path(b.spark, "lake"))
    outcome = batch.run(b.spark, root, lake.root)
    if outcome.failed:
        raise RuntimeError(f"failed checks: {[c for c in outcome.checks if not c.passed]}")
    return lake


def report_sizes(lake: Lake) -> DataFrame:
    """Rows of each list section of the published report."""
    return section_sizes(lake.spark, lake.report_path, [BY_SECTION[n] for n in sorted(ROW_SECTIONS)])


def report_values(lake: Lake) -> DataFrame:
    """Every value of all nine sections of the published report."""
    return section_values(lake.spark, lake.report_path, SECTIONS)


def fact_totals(lake: Lake) -> DataFrame:
    """Rows, counted rows and amount of each published fact."""
    amounts = {"fact_tx_evolucao": "vol", "fact_tx_tipo": "vol", "fact_clientes": "saldo", "fact_propostas": "val", "fact_saques": "vol"}

    def of(table: str, amount: str) -> DataFrame:
        fact = lake.gold(table)
        counted = F.sum("cnt") if "cnt" in fact.columns else F.lit(None)
        return fact.agg(
            F.count(F.lit(1)).alias("groups"), counted.cast("bigint").alias("cnt"),
            numeric.as_double(numeric.money_sum(F.col(amount))).alias("amount"),
        ).withColumn("fact", F.lit(table))
    return reduce(DataFrame.unionByName, [of(t, a) for t, a in amounts.items()])
