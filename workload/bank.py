"""The driver's tables under the canonical bank columns.

Whole tables, native expressions only: nations are branches, customers are clients with one account each, orders are
transactions, line items are credit proposals, suppliers are employees. Customers with a low balance have an
account without a branch, which exercises the unknown-branch rules; those with a very high one have no birth date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallystrata.functions import calendar, labels
from tallystrata.functions.numeric import half_up, rate_mean
from tallystrata.operators.lookup import spread_lookup

MONEY = "decimal(14,2)"
AS_OF = "2024-01-01"
STATES = ("AFRICA", "AMERICA", "ASIA", "EUROPE")
WITHDRAWAL = "low"
YEARS = (1998, 1999, 2000)
APPROVED = "Aprovado"


class Bank:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def branches(self) -> DataFrame:
        region = self.table("region")
        return self.table("nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
            F.col("n_nationkey").cast("bigint").alias("branch_id"),
            F.col("n_name").alias("branch_name"),
            F.replace("n_name", F.lit("NATION_"), F.lit("")).alias("short_name"),
            F.col("r_name").alias("state"),
            F.when(F.col("n_nationkey") == 0, "Digital").otherwise("Física").alias("branch_kind"),
        )

    def clients(self) -> DataFrame:
        birth = F.when(
            F.col("c_acctbal") < 9900, F.date_add(F.lit("1940-01-01").cast("date"), ((F.col("c_custkey") * 37) % 24000).cast("int"))
        )
        joined = F.date_add(F.lit("2010-01-01").cast("date"), ((F.col("c_custkey") * 13) % 4000).cast("int"))
        return self.table("customer").select(
            F.col("c_custkey").alias("client_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.col("c_mktsegment").alias("client_kind"),
            birth.alias("birth_date"),
            joined.alias("joined_at"),
        )

    def silver_clients(self) -> DataFrame:
        return self.clients().withColumn("age_years", calendar.decimal_age(F.col("birth_date"), AS_OF)).withColumn(
            "age_band", labels.age_band(F.col("age_years"))
        )

    def accounts(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("account_id"),
            F.col("c_custkey").alias("client_id"),
            F.when(F.col("c_acctbal") >= 500, F.col("c_nationkey").cast("bigint")).alias("branch_id"),
            F.col("c_acctbal").cast(MONEY).alias("balance"),
            F.col("c_custkey").alias("file_order"),
        )

    def transactions(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("tx_id"),
            F.col("o_custkey").alias("account_id"),
            F.col("o_orderdate").alias("tx_at"),
            F.col("o_orderpriority").alias("tx_type"),
            F.col("o_totalprice").cast(MONEY).alias("amount"),
        )

    def proposals(self, with_client: bool = False) -> DataFrame:
        """``with_client`` joins the orders for the client; analyses that need no client skip it."""
        flag, line = F.col("l_returnflag"), F.col("l_linestatus")
        status = (
            F.when(flag == "A", APPROVED).when((flag == "N") & (line == "O"), "Em análise")
            .when(flag == "N", "Validação").when(line == "O", "Enviada")
        )
        rows = self.table("lineitem").select(
            F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("proposal_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_suppkey").alias("employee_id"),
            F.col("l_shipdate").alias("submitted_at"),
            (F.col("l_discount") * 0.25).alias("monthly_rate"),
            F.col("l_extendedprice").cast(MONEY).alias("proposed_amount"),
            F.col("l_extendedprice").cast(MONEY).alias("financed_amount"),
            F.col("l_quantity").cast(MONEY).alias("down_payment"),
            (F.col("l_quantity") * 2).cast("int").alias("installments"),
            status.alias("status"),
            F.year("l_shipdate").alias("year"),
        )
        if not with_client:
            return rows.drop("order_id")
        owners = self.table("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("client_id"))
        return spread_lookup(rows, owners, "order_id", ["proposal_id"]).drop("order_id")

    def employees(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("employee_id"),
            F.split_part("s_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("s_name", F.lit("#"), F.lit(2)).alias("last_name"),
        )

    def employee_branch(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("employee_id"),
            F.col("s_nationkey").cast("bigint").alias("branch_id"),
            F.col("s_suppkey").alias("file_order"),
        )

    def index(self) -> DataFrame:
        """Monthly index: mean line tax per ship month, as a fraction with six places."""
        return (
            self.table("lineitem").groupBy(F.trunc(F.to_date("l_shipdate"), "MM").alias("month_start"))
            .agg(half_up(rate_mean(F.col("l_tax")), 6).cast("decimal(10,6)").alias("month_rate"))
        )


def busy_day(daily: DataFrame) -> Column:
    """Burst threshold that fits any scale: one and a half times the mean daily count."""
    return daily.agg(F.floor(F.sum("cnt") * 3 / (F.count("cnt") * 2)).alias("threshold")).scalar()
