import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallystrata.operators import lookup
from tallystrata.plans import analytics, facts, job, quality, report, silver, suite
from tallystrata.sources import files
from tallystrata.sources.layers import Lake
from tallystrata.sources.report_store import manifest, read_section
from tallystrata.sources.tables import Field, Table
from workload import raw
from tallystrata.sources.tables import BY_NAME
from workload.bank import Bank

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not at hand")


@pytest.fixture(scope="module")
def raw_root(spark, tmp_path_factory):
    return raw.write_raw(Bank(spark, SF), str(tmp_path_factory.mktemp("raw") / "files"))


@pytest.fixture(scope="module")
def finished(spark, raw_root, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    return job.run(spark, raw_root, root), Lake(spark, root)


def section(lake, name):
    """Rows of a section as they lie in its files, in file order."""
    parts = sorted(Path(lake.report_path, name).glob("part-*.json"))
    return [json.loads(line) for part in parts for line in part.read_text().splitlines()]


def test_raw_files_are_small_and_compressed(raw_root):
    files = [f for table in ("transactions", "proposals") for f in Path(raw_root, BY_NAME[table].file).glob("part-*")]
    assert files and all(f.name.endswith(".csv.gz") for f in files)


def test_all_checks_pass(finished, spark):
    outcome, lake = finished
    assert [c for c in outcome.checks if not c.passed] == []
    assert outcome.failed == 0 and len(outcome.checks) == 8 and outcome.rejected == {}
    assert quality.results_frame(spark, outcome.checks).filter("passed").count() == 8
    assert outcome.rows["bronze"]["transactions"] >= outcome.rows["silver"]["transactions"]
    measures = {c.name: c.measures for c in outcome.checks}
    assert measures["silver.dates"] == {"transactions.undated": 0}
    size = lake.silver("transactions").count()
    assert measures["gold.totals_match"] == {"transactions.dated": size, "fact_tx_evolucao.counted": size}
    assert measures["bronze.files"] == {f"{n}.rows": lake.bronze(n).count() for n in outcome.rows["bronze"]}


def test_observed_counts_are_those_of_the_tables(finished):
    outcome, lake = finished
    for layer, tables in outcome.rows.items():
        read = lake.bronze if layer == "bronze" else lambda n, layer=layer: lake.read(layer, n)
        assert tables == {n: read(n).count() for n in tables}
    assert outcome.report == {s.name: read_section(lake.spark, lake.report_path, s).count() for s in report.SECTIONS}


def test_report_sections(finished, spark):
    _, lake = finished
    listed = manifest(spark, lake.report_path).orderBy("position").collect()
    assert tuple(r.section for r in listed) == quality.REPORT_SECTIONS == tuple(s.name for s in report.SECTIONS)
    for entry in listed:
        rows = section(lake, entry.section)
        assert len(rows) == entry.rows and all(list(r) == entry.columns for r in rows)
        keys = [tuple((r[k] is not None, r[k]) for k in report.BY_SECTION[entry.section].keys) for r in rows]
        assert keys == sorted(keys)
    tempo = section(lake, "tempo")
    of = lambda part: [r for r in tempo if r["part"] == part]
    assert {r["scope"]: r["c"] for r in of("byYear")} == {"all": 1.0, "2020": 0.0, "2021": 0.0, "2022": 0.0}   # no rows in those years
    assert [r["i"] for r in of("tri")] == [1, 2, 3, 4] and [r["i"] for r in of("wd")] == list(range(7))
    assert 0 <= of("rmonths")[0]["p"] <= 1 and len(of("parimpar")) == 1
    dims = section(lake, "dims")
    assert [r["nome"] for r in dims if r["part"] == "faixas"][0] == "Jovem (<25)"
    assert len([r for r in dims if r["part"] == "jurosBins"]) == 8
    assert [r["i"] for r in dims if r["part"] == "agencias"] == list(range(25))


def test_report_agrees_with_facts(finished):
    _, lake = finished
    rows = {s.name: section(lake, s.name) for s in report.SECTIONS}
    tempo = {r["part"]: r["c"] for r in rows["tempo"] if r["scope"] is None}
    total = lake.gold("fact_tx_evolucao").agg(F.sum("cnt")).first()[0]
    assert sum(r["cnt"] for r in rows["txEvo"]) == total == tempo["txTotal"] == lake.silver("transactions").count()
    assert sum(r["cnt"] for r in rows["txType"]) <= total
    assert tempo["txClean"] + sum(
        r.cnt for r in lake.gold("daily_series").filter("cnt > 200").collect()) == tempo["txTotal"]
    assert sum(r["cnt"] for r in rows["propRaw"]) == sum(r["cnt"] for r in rows["propFact"])


def test_published_columns(finished):
    _, lake = finished
    assert lake.gold("fact_tx_evolucao").columns == ["ano", "mes", "ai", "fidx", "cnt", "vol"]
    assert lake.gold("fact_tx_tipo").columns == ["ano", "ai", "fidx", "ti", "cnt", "vol"]
    assert lake.gold("fact_clientes").columns == ["ai", "fidx", "ei", "incY", "cnt", "saldo"]
    assert lake.gold("fact_propostas").columns == ["ano", "ai", "fidx", "si", "cnt", "val", "jur", "parc", "fin", "ent"]
    assert lake.gold("fact_saques").columns == ["ano", "mes", "ai", "fidx", "vol"]


def test_declared_constraints_hold(finished):
    _, lake = finished
    frames = {t.name: lake.silver(t.name) for t in quality.TABLES}
    found = quality.constraint_violations(frames)
    broken = {(r.table, r.constraint, r.column): r.violations for r in found.collect() if r.violations}
    # proposals may lack a date, which only the typed load forbids
    assert set(broken) <= {("proposals", "not_null", "submitted_at")}
    assert found.filter("constraint = 'references'").count() == 6


def test_constraints_find_violations(rows):
    table = Table("t", "", (Field("k", "k", "int", required=True), Field("s", "s", "string", length=2)), "k")
    frames = {"t": rows("k int, s string", (1, "ab"), (1, "abc"), (None, None)), "u": rows("k int", (2,))}
    found = quality.constraint_violations(frames, [table], [quality.Reference("t", "k", "u", "k")])
    assert {(r.constraint, r.column): r.violations for r in found.collect()} == {
        ("not_null", "k"): 1, ("max_length", "s"): 1, ("unique", "k"): 1, ("references", "k"): 2}


def test_without_ingest(spark, finished):
    first, lake = finished
    outcome = job.run(spark, "unused", lake.root, stages=["silver", "gold"])
    assert outcome.rows["gold"] == first.rows["gold"] and "bronze" not in outcome.rows


def test_sql_over_silver_views(spark, finished):
    _, lake = finished
    lake.create_views("silver", ["transactions", "accounts"])
    by_sql = spark.sql("""
        SELECT year(tx_at) AS year, CAST(sum(abs(amount)) AS double) AS volume FROM transactions
        JOIN accounts USING (account_id) GROUP BY 1 ORDER BY 1""")
    by_function = analytics.annual_change(lake.silver("transactions")).select("year", "volume")
    assert by_sql.collect() == by_function.collect()


def test_all_analyses_run_on_silver(finished):
    _, lake = finished
    results = {name: df.collect() for name, df in suite.analyses(lake, "2024-01-01", ("1996-01-01", "2000-12-31")).items()}
    assert len(results) == 17 and all(results.values())
    size = lake.silver("transactions").count()
    assert results["tx_kpis"][0].transactions == size == sum(r.transactions for r in results["tx_by_kind"])
    assert sum(r.share_pct for r in results["status_share"]) == pytest.approx(100, abs=0.05)
    assert len(results["index_running"]) == 60 and results["index_withdrawal_corr"][0].correlation is not None
    assert sum(r.clients for r in results["clients_by_age_band"]) == results["client_kpis"][0].clients


def test_one_stage_alone(spark, finished):
    _, lake = finished
    outcome = job.run(spark, "unused", lake.root, stages=["validate"])
    assert outcome.failed == 0 and outcome.rows == {}


def test_second_run_replaces_the_first(spark, raw_root, finished):
    first, lake = finished
    before, old = {s.name: section(lake, s.name) for s in report.SECTIONS}, lake.path("silver", "clients")
    again = job.run(spark, raw_root, lake.root)
    assert again.rows == first.rows and {s.name: section(lake, s.name) for s in report.SECTIONS} == before
    assert lake.path("silver", "clients") != old and not Path(old).exists()
    for layer in ("bronze", "silver", "gold"):
        assert files.names(spark, f"{lake.root}/{layer}") == files.names(spark, f"{lake.root}/_published/{layer}") == [lake.run_of(layer)]


def test_missing_source_leaves_bronze(spark, finished, tmp_path):
    _, lake = finished
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        job.run(spark, str(tmp_path), lake.root)
    assert lake.bronze("transactions").count() > 0


def test_a_stage_that_fails_leaves_nothing_behind(spark, finished, monkeypatch):
    _, lake = finished
    present = lambda: sorted(str(p) for p in Path(lake.root).rglob("*") if p.is_file())
    before, report_rows = present(), section(lake, "txEvo")

    def fail(*_):
        raise RuntimeError("half way")

    monkeypatch.setattr(job.facts, "rate_histogram", fail)
    with pytest.raises(RuntimeError, match="half way"):
        job.run(spark, "unused", lake.root, stages=["gold"])
    assert present() == before and section(lake, "txEvo") == report_rows
    assert not list(Path(lake.root, "_scratch").glob("*")) if Path(lake.root, "_scratch").exists() else True


def test_facts_are_planned_without_a_job(spark, finished, monkeypatch):
    """With what the silver writes observed, lookups start no job while the plan is made, and find the same hot keys."""
    _, lake = finished
    known = quality.known_tables(lake.measured("silver"))
    tables = [lake.silver(n) for n in ("transactions", "accounts", "clients")]
    branch_ix, client_dim = lake.gold("branch_positions"), lake.gold("client_dimension")
    proposals, bridge = lake.silver("proposals"), lake.silver("employee_branch")
    monkeypatch.setattr(lookup, "at_most", lambda *_: pytest.fail("a size was counted"))
    monkeypatch.setattr(lookup, "key_counts", lambda *_: pytest.fail("keys were counted"))
    for small in (0, lookup.SMALL_ROWS):
        defaults = lookup.spread_lookup.__defaults__
        monkeypatch.setattr(lookup.spread_lookup, "__defaults__", (*defaults[:-1], small))
        cube = facts.tx_cube(*tables, branch_ix, known)
        assert sorted(map(repr, cube.collect())) == sorted(map(repr, lake.gold("tx_cube").collect()))
        placed = facts.placed_proposals(proposals, client_dim, bridge, branch_ix, known=known)
        assert sorted(map(repr, facts.proposal_cube(placed).collect())) == sorted(map(repr, lake.gold("proposal_cube").collect()))
    monkeypatch.undo()
    for (table, column), counts in known.keys.items():
        exact = {str(r[0]): r[1] for r in lake.silver(table).dropna(subset=[column]).groupBy(column).count().collect()}
        assert counts.rows == lake.silver(table).count() and counts.keyed == sum(exact.values())
        assert {k: n for k, n in counts.frequent if n * 50 > counts.rows} == {k: n for k, n in exact.items() if n * 50 > counts.rows}


def test_a_key_with_a_six_hundredth_of_the_rows_is_cut():
    counts = lookup.KeyCounts(6_000_000, 6_000_000, (("a", 10_000), ("b", 1_400)))
    assert dict(counts.hot(4_000).slices) == {"a": 7} and counts.hot(8).balanced


def test_checks_find_a_half_lake(spark, raw_root, tmp_path):
    results = {c.name: c for c in quality.run_checks(Lake(spark, str(tmp_path)))}
    assert not results["bronze.files"].passed and results["bronze.files"].measures["transactions.rows"] is None
    assert results["bronze.non_empty"].passed and results["silver.saldos"].passed
    assert quality.failed(results.values()) == 6
    outcome = job.run(spark, raw_root, str(tmp_path / "half"), stages=["bronze", "silver", "validate"])
    assert {c.name for c in outcome.checks if not c.passed} == {"gold.facts", "gold.totals_match", "gold.json_keys"}


def test_checks_fail_on_bad_measures(spark):
    good = {("silver", t.name, "duplicates"): 0 for t in quality.TABLES if t.key}
    good |= {(layer, table, measure): 7 for name, layer, table, measure, _ in quality.CHECKS if name not in ("silver.pks", "silver.dates")}
    good[("silver", "transactions", "undated")] = 0

    def failing(**changes):
        rows = good | {tuple(k.split("__")): v for k, v in changes.items()}
        frame = spark.createDataFrame([(*k, v) for k, v in rows.items() if v is not None], "layer string, table string, measure string, value bigint")
        return {r.name for r in quality.check_results(spark, frame).filter("not passed").collect()}

    assert failing() == set()
    assert failing(bronze__clients__rows=0) == {"bronze.non_empty"}
    assert failing(bronze__clients__rows=None) == {"bronze.files"}
    assert failing(silver__accounts__duplicates=1) == {"silver.pks"}
    assert failing(silver__transactions__undated=2) == {"silver.dates"}
    assert failing(silver__accounts__negative=99) == set()
    assert failing(silver__transactions__dated=12) == set() and failing(silver__transactions__dated=13) == {"gold.totals_match"}
    assert failing(gold__fact_saques__rows=None) == {"gold.facts"} and failing(report__dims__rows=None) == {"gold.json_keys"}


def test_amounts_keep_all_their_digits(spark, raw_root, tmp_path):
    """A balance beyond twelve digits and one with four places go through all layers."""
    source = tmp_path / "raw"
    shutil.copytree(raw_root, source)
    extra = "num_conta,cod_cliente,cod_agencia,tipo_conta,data_abertura,saldo_total,saldo_disponivel\n"
    (source / "contas.csv" / "extra.csv").write_text(extra + "x1,1,1,PF,2015-05-05,1234567890123456.7891,0\nx2,1,1,PF,2015-05-05,x,0\n")
    job.run(spark, str(source), str(tmp_path / "lake"))
    lake = Lake(spark, str(tmp_path / "lake"))
    accounts = lake.silver("accounts")
    assert dict(accounts.dtypes)["balance"] == "decimal(20,4)"
    assert {str(r.balance) for r in accounts.filter("account_id in ('x1', 'x2')").collect()} == {"1234567890123456.7891", "None"}
    assert lake.gold("totals").first().balance == pytest.approx(float(accounts.agg(F.sum("balance")).first()[0]))
    lost = {(r.table, r.column): r.lost for r in silver.lost_values(lake.bronze("accounts"), "accounts").collect()}
    assert lost[("accounts", "balance")] == 1 and lost[("accounts", "opened_on")] == 0


def test_unknown_stage(spark, tmp_path):
    with pytest.raises(ValueError, match="platinum"):
        job.run(spark, "x", str(tmp_path), stages=["platinum"])
