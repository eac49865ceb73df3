"""Facts over one small bank that holds the edge cases of every rule."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallystrata.functions import casting
from tallystrata.operators import lookup
from tallystrata.plans import dims, facts, quality

YOUNG, ADULT = "Jovem (<25)", "Adulto (25-59)"


def day(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def bank(rows):
    money = lambda df, *names: df.withColumns({n: casting.to_money(F.col(n)) for n in names})
    return {
        "branches": rows("branch_id long, short_name string, state string, branch_kind string",
                         (7, "Sul", "SP", "F"), (3, "Norte", "MG", "D"), (5, "Leste", "RJ", "F")),
        "clients": rows("client_id long, age_band string, joined_at timestamp",
                        (1, YOUNG, day("2015-01-01")), (2, ADULT, day("2016-01-01")), (3, "Indefinida", None),
                        (4, ADULT, day("2016-05-05")), (5, ADULT, day("2016-05-05"))),
        # client 1 has two accounts, the first in file order is at branch 7; A9 has an unknown branch and client
        "accounts": money(rows("account_id string, client_id long, branch_id long, balance string, file_order int",
                               ("A2", 1, 5, "900", 2), ("A1", 1, 7, "100.50", 1), ("B1", 2, 3, "10", 3),
                               ("C1", 3, 7, "1", 4), ("D1", 4, 7, None, 5), ("A9", 99, 55, "7", 6)), "balance"),
        "transactions": money(rows("tx_id long, account_id string, tx_at timestamp, tx_type string, amount string",
                                   (1, "A1", day("2020-01-05"), "Saque A", "-10.10"),
                                   (2, "A1", day("2020-01-06"), "SAQUE B", "5"),
                                   (3, "B1", day("2020-02-06"), "Pix", None),
                                   (4, "A9", day("2020-01-05"), "Pix", "3"),
                                   (5, "zz", day("2020-01-05"), "Pix", "4"),
                                   (6, None, day("2020-01-05"), None, "8"),
                                   (7, "A2", day("2021-01-05"), None, "1")), "amount"),
        "proposals": money(
            rows("proposal_id long, client_id long, employee_id long, monthly_rate double, proposed_amount string, "
                 "financed_amount string, down_payment string, installments int, status string, year int",
                 (1, 1, 10, 0.014, "100", "80", "20", 12, "Aprovada", 2020),
                 (2, 99, 10, 0.007, "50", "50", "0", 24, "Em análise", 2020),   # no client: employee's branch
                 (3, 99, 77, 0.01, "1", "1", "1", 6, "Validação", 2020),          # neither: dropped
                 (4, 5, 11, None, "9", "8", "1", None, None, 0)),                 # client without account
            "proposed_amount", "financed_amount", "down_payment"),
        "employees": rows("employee_id long", (10,), (11,), (12,)),
        "employee_branch": rows("employee_id long, branch_id long, file_order int", (10, 3, 1), (10, 5, 2), (11, 7, 3)),
    }


@pytest.fixture
def branch_ix(bank):
    return facts.branch_positions(bank["branches"])


@pytest.fixture(params=["rows", "cube"])
def cube(request, bank, branch_ix):
    """Facts come out the same from the placed rows and from their roll-up."""
    if request.param == "cube":
        return facts.tx_cube(bank["transactions"], bank["accounts"], bank["clients"], branch_ix)
    return facts.placed_transactions(bank["transactions"], bank["accounts"], bank["clients"], branch_ix)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_branch_positions_follow_the_key(branch_ix):
    assert tuples(branch_ix) == [(3, 0), (5, 1), (7, 2)]


def test_monthly_fact_keeps_unknown_branches(cube):
    assert tuples(facts.tx_evolution(cube)) == sorted([
        (2020, 1, 2, 0, 2, 15.1), (2020, 2, 0, 1, 1, 0.0), (2020, 1, None, 3, 3, 15.0), (2021, 1, 1, 0, 1, 1.0)], key=repr)


def test_type_fact_drops_unknown_branch_and_type(cube):
    type_ix = facts.type_positions(cube)
    assert tuples(type_ix) == sorted([("Pix", 0), ("SAQUE B", 1), ("Saque A", 2)])
    assert tuples(facts.tx_by_type(cube, type_ix)) == [
        (2020, 0, 1, 0, 1, 0.0), (2020, 2, 0, 1, 1, 5.0), (2020, 2, 0, 2, 1, 10.1)]


def test_withdrawal_fact(cube):
    assert tuples(facts.withdrawals(cube)) == [(2020, 1, 2, 0, 15.1)]


def test_client_fact(bank, branch_ix):
    dim = facts.client_dimension(bank["clients"], bank["accounts"], branch_ix)
    assert {r.client_id: r.branch_id for r in dim.collect()} == {1: 7, 2: 3, 3: 7, 4: 7, 5: None}
    # 2 sits in a state outside the list, 3 has no join year, 5 no account; 4 has no balance
    assert tuples(facts.client_facts(dim, bank["branches"])) == [(2, 0, 0, 2015, 1, 100.5), (2, 1, 0, 2016, 1, 0.0)]


@pytest.fixture(params=["rows", "cube"])
def placed(request, bank, branch_ix):
    dim = facts.client_dimension(bank["clients"], bank["accounts"], branch_ix)
    rows = facts.placed_proposals(bank["proposals"], dim, bank["employee_branch"], branch_ix)
    return facts.proposal_cube(rows) if request.param == "cube" else rows


def test_proposal_fact(placed):
    assert tuples(facts.proposal_facts(placed)) == sorted([
        (2020, 2, 0, 1, 1, 100.0, 0.014, 12, 80.0, 20.0),
        (2020, 1, 3, 3, 1, 50.0, 0.007, 24, 50.0, 0.0),   # last branch of employee 10 is 5
        (0, 2, 1, 0, 1, 9.0, 0.0, 0, 8.0, 1.0)], key=repr)


def test_rate_histogram(placed):
    got = tuples(facts.rate_histogram(placed))
    assert got == sorted([(2020, 2, 0, 3, 12, 1), (2020, 1, 3, None, 24, 1), (0, 2, 1, None, None, 1)], key=repr)
    clamped = facts.rate_histogram(placed, clamp_to_zero=True)
    assert sorted(r.rate_bin for r in clamped.collect()) == [0, 0, 3]


def test_dimensions(bank, branch_ix):
    dim = dims.branch_dimension(bank["branches"], bank["employee_branch"], branch_ix)
    assert {(r.branch_ix, r.short_name): r.employees for r in dim.collect()} == {(0, "Norte"): 1, (1, "Leste"): 1, (2, "Sul"): 1}
    totals = dims.grand_totals(bank["clients"], bank["accounts"], bank["employees"], bank["branches"]).first()
    assert tuple(totals) == (5, 6, 3, 3, 1018.5)


def test_branch_without_employees_has_zero(rows):
    got = dims.headcount(rows("branch_id long", (1,), (2,)), rows("employee_id long, branch_id long", (1, 1)))
    assert {r.branch_id: r.employees for r in got.collect()} == {1: 1, 2: 0}


def test_counts_add_up(bank, cube):
    evolution = facts.tx_evolution(cube)
    gap = quality.totals_gap(bank["transactions"], evolution).first()
    assert (gap.source_rows, gap.fact_rows, gap.passed) == (7, 7, True)
    by_type = facts.tx_by_type(cube, facts.type_positions(cube))
    assert by_type.agg(F.sum("cnt")).first()[0] <= gap.fact_rows


@pytest.mark.parametrize("seed", [1, 2])
def test_facts_do_not_depend_on_partitions_or_slices(spark, rows, seed, monkeypatch):
    defaults = lookup.spread_lookup.__defaults__
    monkeypatch.setattr(lookup.spread_lookup, "__defaults__", (*defaults[:-1], 0))   # no side counts as small
    rng = random.Random(seed)
    clients = rows("client_id long, age_band string, joined_at timestamp", *[
        (c, rng.choice([YOUNG, ADULT, None]), day("2015-01-01")) for c in range(20)])
    accounts = rows("account_id long, client_id long, branch_id long", *[
        (a, 0 if a % 3 else rng.randrange(25), rng.randrange(4)) for a in range(60)])
    tx = rows("tx_id long, account_id long, tx_at timestamp, tx_type string, amount double", *[
        (t, 7 if t % 3 == 0 else rng.randrange(70), day(f"2020-0{1 + t % 9}-01"), rng.choice("ab"), t / 4) for t in range(900)])
    branch_ix = rows("branch_id long, branch_ix int", (0, 0), (1, 1), (2, 2))
    got = []
    for partitions, width in ((1, "8"), (9, "64")):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        cube = facts.tx_cube(tx.repartition(partitions), accounts.repartition(partitions), clients, branch_ix)
        got.append(tuples(facts.tx_evolution(cube)))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got[0] == got[1] and sum(r[4] for r in got[0]) == 900
