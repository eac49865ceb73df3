import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tallystrata.plans import load, quality, silver
from tallystrata.sources import delimited, files, records
from tallystrata.sources.delimited import (
    BAD_KEY, CORRUPT, OPEN_QUOTE, REASON, TOO_SHORT, TOO_WIDE, file_encodings, header_of, read_raw, read_typed, with_row_index,
)
from tallystrata.sources.layers import Lake, without_lineage
from tallystrata.sources.scratch import stored
from tallystrata.sources.tables import BY_NAME, INDEX_SERIES, unique_names
from workload import raw


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def bronze(spark, path, **options):
    return stored(read_raw(spark, path, **options))


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "latin-1"])
def test_encodings_keep_accents(spark, tmp_path, encoding):
    path = put(tmp_path / "a b.csv", "nome,uf\nTatuapé,SP\nFísica,RJ\n", encoding)
    assert [r.encoding for r in file_encodings(spark, path).collect()] == ["ISO-8859-1" if encoding == "latin-1" else "UTF-8"]
    df = bronze(spark, path)
    assert df.columns[:2] == ["nome", "uf"]
    assert sorted(r.nome for r in df.collect()) == ["Física", "Tatuapé"]


def test_folder_with_mixed_encodings(spark, tmp_path):
    put(tmp_path / "d/a +a.csv", "nome\nTatuapé\n", "latin-1")
    put(tmp_path / "d/b.csv", "nome\nCerqueira César\n", "utf-8-sig")
    put(tmp_path / "d/c.csv", "nome\nSul\n")
    got = bronze(spark, str(tmp_path / "d"))
    assert sorted((r._source_file, r.nome) for r in got.collect()) == [
        ("a +a.csv", "Tatuapé"), ("b.csv", "Cerqueira César"), ("c.csv", "Sul")]


def test_part_files_of_subfolders_stay_apart(spark, tmp_path):
    put(tmp_path / "d/p=1/part-0.csv", "n\n0\n1\n")
    put(tmp_path / "d/p=2/part-0.csv", "n\n0\n1\n2\n")
    put(tmp_path / "d/p=3/part-0.csv", "n\né\n", "latin-1")
    got = with_row_index(bronze(spark, str(tmp_path / "d")))
    assert sorted((r._source_file, r.n, r._row_idx) for r in got.collect()) == [
        *[("p=1/part-0.csv", str(i), i) for i in range(2)], *[("p=2/part-0.csv", str(i), i) for i in range(3)],
        ("p=3/part-0.csv", "é", 0)]


def test_quotes_and_commas(spark, tmp_path):
    path = put(tmp_path / "t.csv", 'a,b,c\n1,"Av. Paulista, 1436 - ""Bela"" Vista",NA\n2,,x\n')
    assert [tuple(r)[:3] for r in bronze(spark, path).orderBy("a").collect()] == [
        ("1", 'Av. Paulista, 1436 - "Bela" Vista', "NA"), ("2", None, "x")]


def test_wide_rows_are_set_aside_and_short_rows_kept(spark, tmp_path):
    path = put(tmp_path / "t.csv", 'a,b,c\n1,2,3\n4,5\n6,7,8,9\n"x,y",2,3\n')
    df = bronze(spark, path)
    assert [r[CORRUPT] for r in df.filter("_rejected").collect()] == ["6,7,8,9"]
    kept = df.filter("not _rejected").orderBy("a").select("a", "b", "c").collect()
    assert [tuple(r) for r in kept] == [("1", "2", "3"), ("4", "5", None), ("x,y", "2", "3")]


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = put(tmp_path / "t.csv", 'a,b\n1,"two\nlines"\n2,x\n')
    got = with_row_index(bronze(spark, path)).orderBy("_row_idx")
    assert [(r.a, r.b, r._row_idx) for r in got.collect()] == [("1", "two\nlines", 0), ("2", "x", 1)]


@pytest.mark.parametrize("options", [{}, {"encoding": "utf-8"}])
def test_line_breaks_are_found_by_file(spark, tmp_path, options):
    put(tmp_path / "d/a.csv", 'a,b,c\n1,"two\nlines",-100.00\n2,"x ""y"" z",5\n', "utf-8-sig")
    put(tmp_path / "d/b.csv", "a,b,c\n3,z,6\n4,w,7\n")
    if not options:
        put(tmp_path / "d/c.csv", 'a,b,c\n5,"é\n\n, ü",8\n', "latin-1")
        put(tmp_path / "d/e.csv", "a,b,c\n6,é,9\n", "latin-1")
    got = with_row_index(bronze(spark, str(tmp_path / "d"), **options)).orderBy("a").collect()
    want = [("1", "two\nlines", "-100.00", 0), ("2", 'x "y" z', "5", 1), ("3", "z", "6", 0), ("4", "w", "7", 1)]
    assert [(r.a, r.b, r.c, r._row_idx) for r in got] == want + ([] if options else [
        ("5", "é\n\n, ü", "8", 0), ("6", "é", "9", 0)])
    assert not any(r._rejected for r in got)


def whole_and_split(spark, path, block, **options):
    """The same source read by one task, and in blocks of a few bytes."""
    whole = read_raw(spark, path, **options).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        parts = bronze(spark, path, **options)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    return whole, parts


def values(rows, *names):
    return sorted(tuple(r[n] for n in names) for r in rows)


@pytest.mark.parametrize("block", [61, 300])
def test_records_over_several_lines_in_many_blocks(spark, tmp_path, block):
    """Breaks, doubled quotes, blank lines and separators inside quotes, cut at any place, as the csv module reads them."""
    rng = random.Random(block)
    rows = []
    for k in range(80):
        kind = rng.randrange(6)
        note = {0: "plain", 1: 'two\nlines, "quoted"', 2: "\n\nblank\n", 3: ",", 4: 'ends with "', 5: "long\n" * 12}[kind] + f" {k}"
        rows.append((str(k), note if kind != 4 else note + '"', str(k * 7)))
    buffer = io.StringIO()
    writer = csv.writer(buffer, lineterminator="\n")
    writer.writerow(["a", "b", "c"])
    writer.writerows(rows)
    whole, parts = whole_and_split(spark, put(tmp_path / "t.csv", buffer.getvalue()), block)
    assert values(whole, "a", "b", "c") == values(parts.collect(), "a", "b", "c") == sorted(rows)
    assert parts.select("_block_start").distinct().count() > 5 and not any(r._rejected for r in whole)
    order = with_row_index(parts).orderBy("_row_idx").collect()
    assert [(r.a, r._row_idx) for r in order] == [(str(k), k) for k in range(80)]


@pytest.mark.parametrize("block", [47, 10_000])
def test_stray_quotes_are_set_aside_alone(spark, tmp_path, block):
    lines = ["a,b,c"]
    for k in range(60):
        lines.append(f'{k},"stray {k},x' if k in (3, 30, 59) else f'{k},"break {k}\nand, more",{k}' if k % 7 == 5 else f"{k},good,{k}")
    whole, parts = whole_and_split(spark, put(tmp_path / "t.csv", "\n".join(lines)), block)
    for rows in (whole, parts.collect()):
        taken = [r for r in rows if not r._rejected]
        assert sorted(int(r.a) for r in taken) == [k for k in range(60) if k not in (3, 30, 59)]
        assert {r.b for r in taken} == {"good"} | {f"break {k}\nand, more" for k in range(60) if k % 7 == 5}
        assert values([r for r in rows if r._rejected], CORRUPT, REASON) == sorted((f'{k},"stray {k},x', OPEN_QUOTE) for k in (3, 30, 59))


@pytest.mark.parametrize("block", [25, 10_000])
def test_a_stray_quote_does_not_pair_with_a_later_record(spark, tmp_path, block):
    text = 'a,b,c,d,e\n1,"stray,x,y,z\n2,3,4,5,6\n7,"8","9","two\nlines","10"\n11,12,13,14,15\n16,"x\n",17,18,19\n'
    whole, parts = whole_and_split(spark, put(tmp_path / "t.csv", text), block, short_rows="reject")
    for rows in (whole, parts.collect()):
        assert values([r for r in rows if r._rejected], CORRUPT, REASON) == [('1,"stray,x,y,z', OPEN_QUOTE)]
        assert values([r for r in rows if not r._rejected], "a", "b", "d") == sorted(
            [("2", "3", "5"), ("7", "8", "two\nlines"), ("11", "12", "14"), ("16", "x\n", "18")])


def test_reasons(spark, tmp_path):
    header = "cod_agencia,nome,endereco,cidade,uf,data_abertura,tipo_agencia\n"
    good = "1,A,R,C,SP,2020-01-01,x\n2.0,A,R,C,SP,2020-01-01,x\n,A,R,C,SP,2020-01-01,x\n"
    path = put(tmp_path / "t.csv", header + good + 'x1,A,R,C,SP,2020-01-01,x\n3,A\n4,A,R,C,SP,2020-01-01,x,y\n5,"A,R,C,SP,2020-01-01,x\n')
    rows = read_raw(spark, path, table=BY_NAME["branches"], short_rows="reject").collect()
    assert values([r for r in rows if r._rejected], REASON, CORRUPT) == sorted([
        (BAD_KEY, "x1,A,R,C,SP,2020-01-01,x"), (TOO_SHORT, "3,A"), (TOO_WIDE, "4,A,R,C,SP,2020-01-01,x,y"),
        (OPEN_QUOTE, '5,"A,R,C,SP,2020-01-01,x')])
    assert sorted(r.cod_agencia or "" for r in rows if not r._rejected) == ["", "1", "2.0"]
    with pytest.raises(ValueError):
        read_raw(spark, path, short_rows="drop")


def test_a_header_line_counts_once_and_marks_are_dropped(spark, tmp_path):
    put(tmp_path / "d/a.csv", "a,b\n1,2\na,b\n3,4\n", "utf-8-sig")
    put(tmp_path / "d/b.csv", '"a","b"\n5,é\n', "latin-1")
    put(tmp_path / "d/empty.csv", "")
    assert values(read_raw(spark, str(tmp_path / "d")).collect(), "a", "b") == sorted([("1", "2"), ("a", "b"), ("3", "4"), ("5", "é")])


def test_missing_source(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_raw(spark, str(tmp_path / "none.csv"))


def test_files_with_different_headers(spark, tmp_path):
    put(tmp_path / "d/a.csv", "a,b\n1,2\n")
    put(tmp_path / "d/b.csv", "b,a\n2,1\n")
    with pytest.raises(Exception):
        bronze(spark, str(tmp_path / "d")).collect()


def test_repeated_header_names(spark, tmp_path):
    assert unique_names(["ano", "mes", "ano"]) == ["ano", "mes", "ano_2"]
    path = put(tmp_path / "ipca.csv", "ano,mes,indice,no_mes,3_meses,6_meses,ano,12_meses\n"
               "2020,JAN,1.0,0.21,1,2,0.5,4.19\n2020,XXX,1,1,1,1,1,1\n", "utf-8-sig")
    df = bronze(spark, path)
    assert df.columns[:8] == ["ano", "mes", "indice", "no_mes", "3_meses", "6_meses", "ano_2", "12_meses"]
    rows = silver.price_index(df).collect()
    assert [(r.year, r.month, r.month_pct, r.pct_ytd, r.pct_12m) for r in rows] == [(2020, 1, 0.21, 0.5, 4.19)]


def test_row_ordinals_over_many_blocks(spark, tmp_path):
    files = {f"f{n}.csv": 700 + 300 * n for n in range(3)}
    for name, size in files.items():
        put(tmp_path / "d" / name, "n\n" + "".join(f"{i:06}\n" for i in range(size)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        df = bronze(spark, str(tmp_path / "d"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert df.select("_source_file", "_block_start").distinct().count() > 6
    got = with_row_index(df)
    assert got.count() == sum(files.values())
    assert got.filter(F.col("_row_idx") != F.col("n").cast("int")).count() == 0


def test_lineage_columns_and_their_removal(spark, tmp_path):
    path = put(tmp_path / "raw.csv", "a\n1\n")
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.write(read_raw(spark, path), "bronze", "t")
    row = lake.bronze("t", row_index=True).first()
    assert (row._source_file, row._row_idx) == ("raw.csv", 0) and row._ingestion_ts is not None
    assert without_lineage(lake.bronze("t")).columns == ["a"]
    assert lake.rejects("t").count() == 0
    assert lake.exists("bronze", "t") and not lake.exists("silver", "t")


def test_header_of(spark, tmp_path):
    assert header_of(spark, put(tmp_path / "t.csv", '"a,b",c\r\n1,2\r\n', "utf-8-sig")) == ["a,b", "c"]


# --- typed bulk load

TX = "cod_transacao,num_conta,data_transacao,nome_transacao,valor_transacao\n"


def test_typed_load(spark, tmp_path):
    path = put(tmp_path / "t.csv", TX + "1,007,2020-01-02 03:04:05,Saque,-10.50\n")
    df = read_typed(spark, path, BY_NAME["transactions"])
    assert df.dtypes == [("tx_id", "bigint"), ("account_id", "string"), ("tx_at", "timestamp"), ("tx_type", "string"),
                         ("amount", "decimal(14,2)")]
    assert float(df.first().amount) == -10.5 and df.first().account_id == "007"


def test_typed_load_of_the_index_series(spark, tmp_path):
    path = put(tmp_path / "i.csv", "mes_referencia,variacao_mensal,acumulado_12m\n2020-01-01,0.0021,0.0419\n")
    row = read_typed(spark, path, INDEX_SERIES).first()
    assert (str(row.month_start), float(row.month_rate), float(row.rate_12m)) == ("2020-01-01", 0.0021, 0.0419)


def test_known_encoding_needs_no_scan(spark, tmp_path):
    path = put(tmp_path / "t.csv", "nome\nTatuapé\n", "latin-1")
    assert [r.nome for r in read_raw(spark, path, encoding="ISO-8859-1").collect()] == ["Tatuapé"]


def test_typed_load_stops_at_bad_values_and_headers(spark, tmp_path):
    bad = put(tmp_path / "bad.csv", TX + "1,007,someday,Saque,1\n")
    with pytest.raises(Exception):
        read_typed(spark, bad, BY_NAME["transactions"]).collect()
    with pytest.raises(ValueError, match="header"):
        read_typed(spark, put(tmp_path / "h.csv", "x,y\n1,2\n"), BY_NAME["transactions"])


def test_typed_load_without_optional_columns(spark, tmp_path):
    path = put(tmp_path / "c.csv", "num_conta,cod_cliente,cod_agencia,data_abertura,saldo_total\n1,2,3,2020-01-01,5\n")
    row = read_typed(spark, path, BY_NAME["accounts"]).first()
    assert row.available_balance is None and row.account_kind is None and float(row.balance) == 5.0


def test_load_is_all_or_nothing(spark, tmp_path):
    tables = [BY_NAME["transactions"], INDEX_SERIES]
    put(tmp_path / "raw" / "transacoes.csv", TX + "1,007,2020-01-02 03:04:05,Saque,-10.50\n2,007,2020-01-02 03:04:05,Pix,1\n")
    put(tmp_path / "raw" / "ipca_mensal.csv", "mes_referencia,variacao_mensal,acumulado_12m\n2020-01-01,0.0021,0.0419\n")
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    lake = load.load(spark, raw_root, root, tables)
    assert {r.table: r.rows for r in load.load_counts(lake).collect()} == {"transactions": 2, "index_series": 1}
    put(tmp_path / "raw" / "ipca_mensal.csv", "mes_referencia,variacao_mensal,acumulado_12m\n2020-01-01,x,0.0419\n")
    put(tmp_path / "raw" / "transacoes.csv", TX + "3,007,2020-01-02 03:04:05,Saque,-10.50\n")
    with pytest.raises(Exception):
        load.load(spark, raw_root, root, tables)
    again = Lake(spark, root)
    assert {r.table: r.rows for r in load.load_counts(again).collect()} == {"transactions": 2, "index_series": 1}
    assert sorted(r.tx_id for r in again.read("staging", "transactions").collect()) == [1, 2]
    assert files.names(spark, f"{root}/staging") == files.names(spark, f"{root}/_published/staging")


@pytest.mark.parametrize("lines, size", [(1, 1), (3, 40), (1 << 14, 1 << 24)])
def test_records_do_not_depend_on_pieces(spark, tmp_path, monkeypatch, lines, size):
    """What one task sorts is set by the size of the pieces, not by that of a block."""
    monkeypatch.setattr(records, "PIECE_LINES", lines)
    monkeypatch.setattr(delimited, "TOUCHED_BYTES", size)
    text, want = "k,v\n", []
    for i in range(60):
        value = f"a{i}" + "\nb" * (i % 4) if i % 3 else f"c{i}"
        text += f'{i},"{value}"\n' if i % 3 else (f'{i},"{value}\n' if i % 15 == 0 else f"{i},{value}\n")
        want.append((str(i), value) if i % 15 or i % 3 else ("set aside", f'{i},"{value}'))
    got = read_raw(spark, put(tmp_path / "t.csv", text))
    assert sorted((OPEN_QUOTE == r[REASON] and "set aside" or r.k, r[CORRUPT] or r.v) for r in got.collect()) == sorted(want)
    parts = records.assemble(delimited._lines(spark, str(tmp_path / "t.csv")).withColumn("_text", F.col("_raw")).drop("_raw"), 2, 7)
    assert parts.filter("not _stray").count() == len(want) - 4 + 1   # and the header


def test_faulty_rows_are_written_by_ranges(spark, tmp_path, monkeypatch):
    """Each range of keys is a file of its own, with a header; no task sorts all rows."""
    bank, one = raw.Bank(spark, "/root/testdata/sf0.001"), None
    for coalesced, files_least in (("true", 1), ("false", 3)):
        path = str(tmp_path / coalesced)
        monkeypatch.setattr(raw, "scratch_path", lambda spark, name: f"{path}/{name}")  # noqa: B023
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
        found = sorted(tuple(r) for r in raw.rejects(bank).collect())
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        written = list((tmp_path / coalesced).glob("raw/*/part-*"))
        assert len(written) >= files_least and all(f.read_text().startswith("cod_transacao,") for f in written)
        one = one or found
        assert found == one


def test_scanned_measures_are_kept_with_the_observed(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write(spark.range(5), "bronze", "t", {"rows": F.count(F.lit(1))}, {"last": F.max("id")})
    assert lake.measured("bronze") == {"t": {"rows": 5, "last": 4}}
    table = BY_NAME["proposals"]
    rows = spark.createDataFrame([("1.5", False, None)], f"valor_proposta string, _rejected boolean, {REASON} string")
    assert not [m for m in quality.bronze_measures(rows, table) if m.startswith("digits")]
    assert quality.amount_measures(rows, table).keys() == {"digits:valor_proposta", "places:valor_proposta"}
