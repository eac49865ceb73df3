import datetime as dt

from tallystrata.plans import silver

POS = ("_pos",)


def raw(rows, names, *values):
    """Text columns plus the file position."""
    schema = ", ".join(f"`{n}` string" for n in names) + ", _pos int"
    return rows(schema, *[(*v, i) for i, v in enumerate(values)])


def test_branches(rows):
    names = ["cod_agencia", "nome", "endereco", "cidade", "uf", "data_abertura", "tipo_agencia"]
    df = raw(rows, names, ("2", "Agência Sul ", "x", "c", "SP", "2010-06-14", "Física"),
             ("2", "Agencia Outra", "x", "c", "RJ", "2011-01-01", "Digital"), ("1", None, "x", "c", "SP", "nunca", None))
    got = {r.branch_id: r for r in silver.branches(df, POS).collect()}
    assert got[2].short_name == "Sul" and got[2].state == "SP" and got[2].opened_on == dt.date(2010, 6, 14)
    assert got[1].short_name is None and got[1].opened_on is None


def test_clients(rows):
    df = raw(rows, ["cod_cliente", "data_nascimento", "data_inclusao"],
             ("1", "1999-01-15", "2015-03-01 10:00:00 UTC"), ("1", "1950-01-01", "2016-01-01"),
             (None, None, "x"), (None, "1980-01-01", None))
    got = {r.client_id: r for r in silver.clients(df, POS).collect()}
    assert len(got) == 2   # rows without a key count as one
    assert (got[1].age_years, got[1].age_band) == (25.0, "Adulto (25-59)")
    assert got[1].joined_at.year == 2015
    assert (got[None].age_band, got[None].joined_at) == ("Indefinida", None)
    assert got[1].first_name is None   # optional columns appear as nulls


def test_accounts_without_optional_balance(rows):
    names = ["num_conta", "cod_cliente", "cod_agencia", "saldo_total", "data_abertura"]
    df = raw(rows, names, ("A1", "1", "2", "10.50", "2020-01-01"), ("A1", "9", "9", "99", "2020-01-01"),
             ("A2", "1", "3", "dez", None))
    got = {r.account_id: r for r in silver.accounts(df, POS).collect()}
    assert float(got["A1"].balance) == 10.5 and got["A1"].available_balance is None
    assert got["A2"].balance is None and got["A1"].file_order < got["A2"].file_order


def test_transactions_drop_bad_dates_before_dedup(rows):
    names = ["cod_transacao", "num_conta", "data_transacao", "nome_transacao", "valor_transacao"]
    df = raw(rows, names,
             ("1", "A", "sem data", "Saque", "1"), ("1", "A", "2024-01-01 10:00:00 UTC", "Saque", "-2.50"),
             ("1", "A", "2024-01-02", "Saque", "3"), ("2", "A", "2024-01-07T00:00:00Z", "Pix", "abc"))
    got = {r.tx_id: r for r in silver.transactions(df, POS).collect()}
    assert float(got[1].amount) == -2.5 and float(got[1].amount_abs) == 2.5
    assert (got[1].year, got[1].month, got[1].weekday) == (2024, 1, 0)
    assert got[2].amount is None and got[2].weekday == 6
    assert dict(silver.transactions(df, POS).dtypes)["year"] == "int"


def test_proposals(rows):
    names = ["cod_proposta", "cod_cliente", "cod_colaborador", "data_entrada_proposta", "taxa_juros_mensal",
             "valor_proposta", "valor_financiamento", "valor_entrada", "valor_prestacao", "quantidade_parcelas",
             "status_proposta"]
    df = raw(rows, names, ("1", "1", "1", "2021-05-05", "0.0167", "100", "80", "20", "5", "12", "Aprovada"),
             ("2", "1", "1", "?", "alta", "x", "80", "20", "5", "12.0", None))
    got = {r.proposal_id: r for r in silver.proposals(df, POS).collect()}
    assert (got[1].year, got[1].monthly_rate, got[1].installments) == (2021, 0.0167, 12)
    assert (got[2].year, got[2].monthly_rate, got[2].proposed_amount, got[2].installments) == (0, None, None, 12)
    assert got[1].grace_months is None


def test_employees_and_bridge(rows):
    df = raw(rows, ["cod_colaborador", "primeiro_nome"], ("1", "Ana"), ("1", "Bia"), ("2", "Caio"))
    assert sorted((r.employee_id, r.first_name) for r in silver.employees(df, POS).collect()) == [(1, "Ana"), (2, "Caio")]
    bridge = raw(rows, ["cod_colaborador", "cod_agencia"], ("1", "5"), ("1", "6"), ("1", "5"), ("2", "5"))
    got = silver.employee_branch(bridge, POS)
    assert sorted((r.employee_id, r.branch_id) for r in got.collect()) == [(1, 5), (1, 6), (2, 5)]


def test_marks_of_missing_values(rows):
    df = raw(rows, ["cod_colaborador", "primeiro_nome", "data_nascimento"], ("1", "NA", "NaT"), ("None", "Bia", "N/A"), ("2", "nan", "2000-01-01"))
    got = silver.employees(df, POS).collect()
    assert sorted(((r.employee_id, r.first_name, r.birth_date) for r in got), key=repr) == sorted(
        [(1, None, None), (None, "Bia", None), (2, None, dt.date(2000, 1, 1))], key=repr)


def test_index_series(rows):
    df = rows("year int, month int, month_pct double, pct_12m double", (2020, 3, 0.07, 3.3), (2020, 4, None, None))
    got = {r.month_start: r for r in silver.index_series(df).collect()}
    assert float(got[dt.date(2020, 3, 1)].month_rate) == 0.0007
    assert got[dt.date(2020, 4, 1)].month_rate is None


def test_no_lineage_is_left(rows):
    df = raw(rows, ["cod_colaborador", "primeiro_nome"], ("1", "Ana"))
    assert not [c for c in silver.employees(df, POS).columns if c.startswith("_")]
