"""What the scans of raw lines and of bronze share, and that the faster readings give the same rows."""

import random

import pytest
from pyspark.sql import functions as F

from tallystrata.functions import casting, layouts
from tallystrata.plans import job, quality, silver
from tallystrata.sources import delimited
from tallystrata.sources.delimited import BAD_KEY, REASON, TOO_SHORT, TOO_WIDE, read_raw
from tallystrata.sources.layers import Lake
from tallystrata.sources.tables import BY_NAME, TABLES


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_not_sorted_for_their_blocks(spark, tmp_path):
    path = put(tmp_path / "t.csv", "a,b\n1,2\n")
    found = plan(delimited._blocks(delimited._lines(spark, path), "a,b", None))
    assert "HashAggregate" in found and "SortAggregate" not in found


def test_fields_are_counted_where_the_parser_finds_another_number(spark, tmp_path):
    path = put(tmp_path / "t.csv", '_off,a,b\n1,2,3\n2,3\n3,4,5,6\n4,"x,y",z\n5,"x""y",z,w\n6,,\n7,a"b,c\n x,1,2\n')
    table = BY_NAME["employees"]
    rows = read_raw(spark, path, short_rows="reject").collect()
    assert sorted((r["_off"], r.a, r.b, r[REASON]) for r in rows if r.a) == [
        (" x", "1", "2", None), ("1", "2", "3", None), ("2", "3", None, TOO_SHORT), ("3", "4", "5", TOO_WIDE), ("4", "x,y", "z", None),
        ("5", 'x"y', "z", TOO_WIDE), ("7", 'a"b', "c", None)]
    assert [(r.a, r.b, r[REASON]) for r in rows if not r.a] == [(None, None, None)]
    keyed = put(tmp_path / "k.csv", "cod_colaborador,primeiro_nome\n1,a\n2.0,b\n x,c\nNA,d\n,e\n 3 ,f\n2.5,g\n")
    got = read_raw(spark, keyed, table=table).collect()
    assert [r.primeiro_nome for r in got if r[REASON] == BAD_KEY] == ["c", "g"]


def test_source_names_do_not_depend_on_the_file_that_is_known(spark, tmp_path):
    for name in ("x/d/a.csv", "d/x/d/b.csv", "d/c c.csv", "d/e.csv", "d/p=1+2/e.csv"):
        put(tmp_path / "d" / name, "n\n1\n")
    root = str(tmp_path / "d")
    lines = spark.read.option("recursiveFileLookup", "true").text(root)
    path = F.col("_metadata.file_path").alias("path")
    named = lambda file: sorted(tuple(r) for r in lines.select(path, delimited._source_name(root, file)).distinct().collect())
    want = named("")
    assert len(want) == 5 and all(named(file) == want for file, _ in want)
    one = put(tmp_path / "single.csv", "n\n1\n")
    line, file = delimited._first_line(spark, one, None)
    assert line == "n" and {r._source_file for r in delimited._lines(spark, one, file).collect()} == {"single.csv"}


@pytest.mark.parametrize("marked, legacy", [(True, False), (False, True)])
def test_headers_with_accents_in_either_encoding(spark, tmp_path, marked, legacy):
    put(tmp_path / "d/a.csv", "é,b\n1,x\n", "utf-8-sig" if marked else "utf-8")
    put(tmp_path / "d/b.csv", "é,b\n2,ü\n", "latin-1" if legacy else "utf-8")
    rows = read_raw(spark, str(tmp_path / "d")).collect()
    assert sorted((r["é"], r.b) for r in rows) == [("1", "x"), ("2", "ü")]
    (tmp_path / "d/c.csv").write_bytes(b"\xef\xbb\xbfb,b\n3,\xfc\n")
    with pytest.raises(ValueError, match="another header"):
        read_raw(spark, str(tmp_path / "d"))


def test_keys_and_numbers_that_need_a_second_look(rows):
    texts = ["1", " 2 ", "3.0", "3.00 ", "4.5", "", " ", "NA", "NaN", "x", "1,2", "+7", "007", "1e2", "99999999999999999999", ".0", None]
    df = rows("t string", *[(t,) for t in texts])
    text = F.col("t")
    got = df.select("t", casting.try_key(text).alias("k"), casting.is_bad_key(text).alias("bad"), casting.to_int(text).alias("n")).collect()
    keys = [1, 2, 3, 3, None, None, None, None, None, None, None, 7, 7, None, None, None, None]
    assert [r.k for r in got] == keys
    assert [r.t for r in got if r.bad] == ["4.5", "x", "1,2", "1e2", "99999999999999999999", ".0"]
    assert [r.n for r in got] == [1, 2, 3, 3, 4, None, None, None, None, None, None, 7, 7, 100, None, 0, None]


def test_layouts_found_beside_the_digits(spark, rows):
    rng = random.Random(3)
    spelled = ["2020-03-%02d", "%02d/03/2020", "03/%02d/2020", "2020/03/%02d 10:00:00", "%d-3-2020", "%d.3.2020", "202003%02d", "x%d", "1-1-2-%d"]
    for heavy in range(7):
        values = [(rng.choice(spelled + [spelled[heavy]] * 9) % rng.randrange(1, 29), rng.random() < 0.3) for _ in range(150)]
        df = rows("a string, _rejected boolean", *values)
        for kind in ("date", "timestamp"):
            told = df.agg(*[m.alias(n) for n, m in layouts.layout_measures({"a": kind}, ~F.col("_rejected")).items()]).first()
            kept = df.filter("not _rejected").select("a")
            assert told["layout:a"] == layouts.votes(kept, {"a": kind}).first().a
            known = layouts.dated(kept, {"a": kind}, {"a": told["layout:a"]})
            assert sorted(map(str, known.collect())) == sorted(map(str, layouts.dated(kept, {"a": kind}).collect()))


def test_silver_does_not_look_for_layouts_that_bronze_found(spark, tmp_path):
    """A lake whose tables each have a header and two rows; dates day first."""
    day = {"date": "13/02/2020", "timestamp": "2020-02-13 10:00:00", "bigint": "1", "int": "1", "string": "a"}
    for table in TABLES:
        header = ",".join(f.raw for f in table.fields)
        row = ",".join(day.get(f.type, "1.5") for f in table.fields)
        put(tmp_path / "raw" / table.file, f"{header}\n{row}\n{row.replace('a', 'b')},\n")
    lake = Lake(spark, str(tmp_path / "lake"))
    job.run(spark, str(tmp_path / "raw"), lake.root, ["bronze", "silver"])
    found = lake.measured("bronze")
    assert found["clients"] | {"rows": 1, "rejected": 1, "layout:data_nascimento": 3, "layout:data_inclusao": 0} == found["clients"]
    assert str(lake.silver("clients").first().birth_date) == "2020-02-13"
    rows = lake.bronze("clients")
    assert "Subquery" in plan(silver.clients(rows)) and "Subquery" not in plan(silver.clients(rows, dates={"birth_date": 3}))
    assert quality.date_measures(rows, BY_NAME["price_index"]) == {}
