"""The ``customer_usage`` table: one row per customer, derived from the driver's TPC-H-like tables.

Plan shape (checked with ``explain``):

* ``lineitem`` is reduced to one row per order first (partial + final hash aggregate), so a
  hot order key is folded map-side and never reaches a join.
* ``orders`` LEFT JOIN that per-order table on the unique order key (sort-merge, 1:1), then one
  aggregate per customer computes the order-level and the line-level measures in a single pass
  over ``orders`` (again partial aggregation, so a customer holding a third of all orders is fine).
* ``customer`` joins the per-customer table 1:1; ``nation`` (25 rows) is left to Spark's
  size-checked automatic broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S

# Fixed values of the fixture mapping (documented in FIXTURES.md section 6).
INTL_DISCOUNT = 0.085
DAY_FLAG, EVE_FLAG, NIGHT_FLAG = "N", "A", "R"
CHARGE_RATE = {"day": 0.17, "eve": 0.085, "night": 0.045, "intl": 0.27}
INTL_SEGMENT = "BUILDING"
VMAIL_BALANCE = 6000
URGENT, LOW = "1-URGENT", "5-LOW"
CHURN_BEFORE = "2000-08-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def _sum_if(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(F.lit(0.0)))


def customer_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customer table (FIXTURES.md section 1 columns), one row per customer."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_returnflag")
    dom = F.col("l_discount") <= INTL_DISCOUNT
    intl = F.col("l_discount") > INTL_DISCOUNT
    flag = F.col("l_returnflag")
    q = F.col("l_quantity")
    per_order = li.groupBy("l_orderkey").agg(
        _sum_if(dom & (flag == DAY_FLAG), q).alias("day_m"),
        _sum_if(dom & (flag == EVE_FLAG), q).alias("eve_m"),
        _sum_if(dom & (flag == NIGHT_FLAG), q).alias("night_m"),
        _sum_if(intl, q).alias("intl_m"),
        _count_if(dom & (flag == DAY_FLAG)).alias("day_c"),
        _count_if(dom & (flag == EVE_FLAG)).alias("eve_c"),
        _count_if(dom & (flag == NIGHT_FLAG)).alias("night_c"),
        _count_if(intl).alias("intl_c"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    odate = F.to_date("o_orderdate")
    per_cust = (
        joined.groupBy("o_custkey").agg(
            F.min(odate).alias("first_d"),
            F.max(odate).alias("last_d"),
            _count_if(F.col("o_orderpriority") == URGENT).alias("urgent"),
            _count_if(F.col("o_orderpriority") == LOW).alias("low"),
            F.count("l_orderkey").alias("n_line_orders"),
            *[F.sum(c).alias(c) for c in ["day_m", "eve_m", "night_m", "intl_m"]],
            *[F.sum(c).cast("bigint").alias(c) for c in ["day_c", "eve_c", "night_c", "intl_c"]],
        )
        # customers whose orders have no line items are absent, as with an inner join
        .where(F.col("n_line_orders") > 0)
    )
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = (cust.join(nation, cust.c_nationkey == nation.n_nationkey)
            .join(per_cust, cust.c_custkey == per_cust.o_custkey))
    vm = F.col("c_acctbal") > VMAIL_BALANCE
    return base.select(
        F.col("c_custkey").cast("bigint").alias(S.ID),
        F.col("n_name").alias("state"),
        (F.datediff("last_d", "first_d") + 1).cast("int").alias("account_length"),
        (F.lit(408) + F.col("c_custkey") % 3).cast("int").alias("area_code"),
        F.when(F.col("c_mktsegment") == INTL_SEGMENT, "Yes").otherwise("No").alias("international_plan"),
        F.when(vm, "Yes").otherwise("No").alias("voice_mail_plan"),
        F.when(vm, F.col("low")).otherwise(F.lit(0)).cast("bigint").alias("number_vmail_messages"),
        F.col("day_m").alias("total_day_minutes"),
        F.col("day_c").alias("total_day_calls"),
        (F.col("day_m") * CHARGE_RATE["day"]).alias("total_day_charge"),
        F.col("eve_m").alias("total_eve_minutes"),
        F.col("eve_c").alias("total_eve_calls"),
        (F.col("eve_m") * CHARGE_RATE["eve"]).alias("total_eve_charge"),
        F.col("night_m").alias("total_night_minutes"),
        F.col("night_c").alias("total_night_calls"),
        (F.col("night_m") * CHARGE_RATE["night"]).alias("total_night_charge"),
        F.col("intl_m").alias("total_intl_minutes"),
        F.col("intl_c").alias("total_intl_calls"),
        (F.col("intl_m") * CHARGE_RATE["intl"]).alias("total_intl_charge"),
        F.col("urgent").alias("customer_service_calls"),
        (F.col("last_d") < F.lit(CHURN_BEFORE).cast("date")).alias(S.LABEL),
    )


def dirty_customer_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture variant with NULLs and repeated rows, for the cleaning operators.

    state NULL when id % 41 = 0, voice_mail_plan NULL when id % 43 = 0, total_eve_minutes NULL
    when id % 37 = 0; rows with id % 50 = 0 appear twice. Every row is kept.
    """
    cid = F.col(S.ID)
    base = customer_usage(spark, sf_dir).withColumns({
        "state": F.when(cid % 41 == 0, F.lit(None).cast("string")).otherwise(F.col("state")),
        "voice_mail_plan": F.when(cid % 43 == 0, F.lit(None).cast("string")).otherwise(F.col("voice_mail_plan")),
        "total_eve_minutes": F.when(cid % 37 == 0, F.lit(None).cast("double")).otherwise(F.col("total_eve_minutes")),
    })
    return base.unionByName(base.where(cid % 50 == 0))


# Deterministic stand-in score used where an oracle needs fit-independent scores.
def standin_score(id_col: str = S.ID) -> Column:
    return ((F.col(id_col) * 7919) % 1000) / F.lit(1000.0)
