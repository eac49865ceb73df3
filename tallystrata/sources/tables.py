"""Registry of the eight source tables: raw file, raw and canonical column names, types, keys and references."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    raw: str            # header text in the raw file
    name: str           # canonical name from silver on
    type: str           # type of the typed bulk load
    required: bool = False   # NOT NULL
    optional: bool = False   # the raw file may lack the column
    length: int | None = None   # longest text allowed


@dataclass(frozen=True)
class Table:
    name: str
    file: str
    fields: tuple[Field, ...]
    key: str | None = None

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, _type(f.type), not f.required) for f in self.fields])

    def renames(self) -> dict[str, str]:
        return dict(zip(unique_names([f.raw for f in self.fields]), [f.name for f in self.fields]))


@dataclass(frozen=True)
class Reference:
    child: str
    column: str
    parent: str
    parent_column: str


def _type(text: str) -> T.DataType:
    return T.StructType.fromDDL(f"c {text}")["c"].dataType


def unique_names(names: list[str]) -> list[str]:
    """Header names by position; the n-th repeat of a name gets the suffix ``_n``."""
    seen: dict[str, int] = {}
    result = []
    for name in names:
        seen[name] = seen.get(name, 0) + 1
        result.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return result


# File names and header texts are the input contract.
TABLES: tuple[Table, ...] = (
    Table("branches", "agencias.csv", (
        Field("cod_agencia", "branch_id", "bigint", required=True),
        Field("nome", "branch_name", "string", required=True, length=120),
        Field("endereco", "address", "string", length=200),
        Field("cidade", "city", "string", length=80),
        Field("uf", "state", "string", length=2),
        Field("data_abertura", "opened_on", "date"),
        Field("tipo_agencia", "branch_kind", "string", length=40),
    ), key="branch_id"),
    Table("clients", "clientes.csv", (
        Field("cod_cliente", "client_id", "bigint", required=True),
        Field("primeiro_nome", "first_name", "string", optional=True, length=60),
        Field("ultimo_nome", "last_name", "string", optional=True, length=80),
        Field("email", "email", "string", optional=True, length=120),
        Field("tipo_cliente", "client_kind", "string", required=True, optional=True, length=15),
        Field("data_nascimento", "birth_date", "date"),
        Field("cpfcnpj", "tax_id", "string", optional=True, length=20),
        Field("endereco", "address", "string", optional=True, length=200),
        Field("cep", "postcode", "string", optional=True, length=15),
        Field("data_inclusao", "joined_at", "timestamp"),
    ), key="client_id"),
    Table("employees", "colaboradores.csv", (
        Field("cod_colaborador", "employee_id", "bigint", required=True),
        Field("primeiro_nome", "first_name", "string", optional=True, length=60),
        Field("ultimo_nome", "last_name", "string", optional=True, length=80),
        Field("email", "email", "string", optional=True),
        Field("cpf", "tax_id", "string", optional=True),
        Field("data_nascimento", "birth_date", "date", optional=True),
        Field("endereco", "address", "string", optional=True),
        Field("cep", "postcode", "string", optional=True),
        Field("cargo", "role", "string", optional=True, length=80),
    ), key="employee_id"),
    Table("employee_branch", "colaborador_agencia.csv", (
        Field("cod_colaborador", "employee_id", "bigint", required=True),
        Field("cod_agencia", "branch_id", "bigint", required=True),
    )),
    Table("accounts", "contas.csv", (
        Field("num_conta", "account_id", "string", required=True, length=20),
        Field("cod_cliente", "client_id", "bigint"),
        Field("cod_agencia", "branch_id", "bigint"),
        Field("tipo_conta", "account_kind", "string", optional=True, length=40),
        Field("data_abertura", "opened_on", "date"),
        Field("saldo_total", "balance", "decimal(14,2)"),
        Field("saldo_disponivel", "available_balance", "decimal(14,2)", optional=True),
    ), key="account_id"),
    Table("proposals", "propostas_credito.csv", (
        Field("cod_proposta", "proposal_id", "bigint", required=True),
        Field("cod_cliente", "client_id", "bigint"),
        Field("cod_colaborador", "employee_id", "bigint"),
        Field("data_entrada_proposta", "submitted_at", "timestamp", required=True),
        Field("taxa_juros_mensal", "monthly_rate", "decimal(6,4)"),
        Field("valor_proposta", "proposed_amount", "decimal(14,2)"),
        Field("valor_financiamento", "financed_amount", "decimal(14,2)"),
        Field("valor_entrada", "down_payment", "decimal(14,2)"),
        Field("valor_prestacao", "installment_amount", "decimal(14,2)", optional=True),
        Field("quantidade_parcelas", "installments", "int"),
        Field("carencia", "grace_months", "int", optional=True),
        Field("status_proposta", "status", "string", length=40),
    ), key="proposal_id"),
    Table("transactions", "transacoes.csv", (
        Field("cod_transacao", "tx_id", "bigint", required=True),
        Field("num_conta", "account_id", "string", length=20),
        Field("data_transacao", "tx_at", "timestamp", required=True),
        Field("nome_transacao", "tx_type", "string", length=80),
        Field("valor_transacao", "amount", "decimal(14,2)"),
    ), key="tx_id"),
    Table("price_index", "ipca.csv", (
        Field("ano", "year", "int", required=True),
        Field("mes", "month_name", "string", required=True),
        Field("indice", "index_level", "double"),
        Field("no_mes", "month_pct", "double"),
        Field("3_meses", "pct_3m", "double"),
        Field("6_meses", "pct_6m", "double"),
        Field("ano", "pct_ytd", "double"),
        Field("12_meses", "pct_12m", "double"),
    )),
)

REFERENCES: tuple[Reference, ...] = (
    Reference("employee_branch", "branch_id", "branches", "branch_id"),
    Reference("accounts", "client_id", "clients", "client_id"),
    Reference("accounts", "branch_id", "branches", "branch_id"),
    Reference("proposals", "client_id", "clients", "client_id"),
    Reference("proposals", "employee_id", "employees", "employee_id"),
    Reference("transactions", "account_id", "accounts", "account_id"),
)

BY_NAME: dict[str, Table] = {t.name: t for t in TABLES}

# Monthly index in the form the analyses use: one row per month, fractions.
INDEX_SERIES = Table("index_series", "ipca_mensal.csv", (
    Field("mes_referencia", "month_start", "date", required=True),
    Field("variacao_mensal", "month_rate", "decimal(6,4)"),
    Field("acumulado_12m", "rate_12m", "decimal(6,4)"),
), key="month_start")


def tables() -> Iterator[Table]:
    return iter(TABLES)
