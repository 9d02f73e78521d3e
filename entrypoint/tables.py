"""The driver's tables in the roles of the seven loan sources, for Spark; ``oracle`` holds the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.functions import hashed_uniform
from lendlens.session import materialize

KEY, TARGET = "SK_ID_CURR", "TARGET"
DAY_ZERO = "2002-01-01"


# declared, so that planning needs no job to read file footers
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def order_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(SK_ID_CURR, balance, price, cnt, TARGET) per customer.

    The planted rare class depends on mean order price, order count and balance.
    """
    orders = read(spark, sf_dir, "orders")
    per_customer = orders.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("price"), F.count("*").alias("cnt"))
    base = materialize(
        read(spark, sf_dir, "customer")
        .join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias(KEY),
            F.col("c_acctbal").alias("balance"),
            F.coalesce("price", F.lit(0.0)).alias("price"),
            F.coalesce("cnt", F.lit(0)).cast("double").alias("cnt"),
        ),
        "signals",
    )
    # one row of means and deviations, so the target is a plain expression over the base rows
    z = base.agg(
        *[f(c).alias(f"{n}_{c}") for c in ("price", "cnt", "balance") for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    ).first()

    def standard(c: str):
        return (F.col(c) - z[f"m_{c}"]) / z[f"s_{c}"]

    logit = F.lit(3.0) - standard("price") + 0.8 * standard("cnt") - 0.8 * standard("balance")
    bad = hashed_uniform(F.col(KEY), 42) < 1.0 / (1.0 + F.exp(logit))
    return base.withColumn(TARGET, bad.cast("int"))


def planted_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_signals(spark, sf_dir).select(KEY, TARGET)


def application_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as the application table, without a target."""
    key = F.col("c_custkey")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    customer = read(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    null = F.lit(None)
    return customer.select(
        key.alias("SK_ID_CURR"),
        (F.col("c_acctbal") + 1500.0).alias("AMT_INCOME_TOTAL"),
        (((key * 7919) % 90000) + 1000).cast("double").alias("AMT_CREDIT"),
        F.when(F.col("c_nationkey") == 3, null).otherwise(((key * 31) % 4000 + 100).cast("double")).alias("AMT_ANNUITY"),
        F.when(F.col("c_nationkey") == 5, null).otherwise(((key * 7907) % 80000).cast("double")).alias("AMT_GOODS_PRICE"),
        (-(F.lit(7000) + (key * 37) % 18000)).alias("DAYS_BIRTH"),
        F.when(key % 11 == 0, F.lit(365243)).otherwise(-((key * 53) % 9000)).cast("bigint").alias("DAYS_EMPLOYED"),
        F.when(key % 7 == 0, null).otherwise((F.col("c_acctbal") + 1000.0) / 11000.0).alias("EXT_SOURCE_1"),
        F.when(key % 13 == 0, null).otherwise(hashed_uniform(key, "ext")).alias("EXT_SOURCE_2"),
        F.when(key % 5 < 2, null).otherwise((key * 17 % 100) / 100.0).alias("EXT_SOURCE_3"),
        (F.col("n_regionkey") + 1).cast("int").alias("REGION_RATING_CLIENT"),
        (key % 2).cast("int").alias("FLAG_PHONE"),
        (key % 4).cast("int").alias("CNT_CHILDREN"),
        F.when(F.col("c_nationkey") == 7, null).otherwise(F.col("c_mktsegment")).alias("NAME_SEGMENT"),
        F.col("n_name").alias("ORGANIZATION_NATION"),
        F.when(key % 3 == 0, "Y").otherwise("N").alias("FLAG_OWN_CAR"),
    )


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_BUREAU"),
        F.datediff(F.to_date("o_orderdate"), F.lit(DAY_ZERO).cast("date")).cast("bigint").alias("DAYS_CREDIT"),
        F.col("o_totalprice").alias("AMT_CREDIT_SUM"),
        F.when(F.col("o_orderstatus") == "F", F.lit(None)).otherwise(F.col("o_totalprice") * 0.5).alias("AMT_CREDIT_SUM_DEBT"),
        F.col("o_orderstatus").alias("CREDIT_ACTIVE"),
    )


def bureau_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        (-F.col("l_linenumber")).cast("bigint").alias("MONTHS_BALANCE"),
        F.when(flag == "N", "0").when(flag == "R", "1").otherwise("C").alias("STATUS"),
    )


def previous_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_PREV"),
        (F.col("o_totalprice") * 0.25).alias("AMT_APPLICATION"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("CNT_PAYMENT"),
        F.col("o_orderstatus").alias("NAME_CONTRACT_STATUS"),
    )


def credit_card_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("SK_ID_CURR"),
        F.col("event_id").alias("SK_ID_PREV"),
        F.col("value").alias("AMT_BALANCE"),
        F.when(F.col("event_type") == "error", F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("SK_DPD_DEF"),
        F.col("event_type").alias("NAME_CONTRACT_STATUS"),
    )


def pos_cash_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("SK_ID_CURR"),
        F.col("event_id").alias("SK_ID_PREV"),
        F.hour("ts").cast("bigint").alias("CNT_INSTALMENT"),
    )


def installments_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    owners = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    price = F.col("l_extendedprice")
    return lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("l_linenumber").cast("bigint").alias("NUM_INSTALMENT_NUMBER"),
        price.alias("AMT_INSTALMENT"),
        F.when(F.col("l_discount") == 0.1, F.lit(None)).otherwise(price * (1.0 - F.col("l_discount"))).alias("AMT_PAYMENT"),
    )


SIDES = {
    "bureau": bureau,
    "bureau_balance": bureau_balance,
    "previous_application": previous_application,
    "credit_card_balance": credit_card_balance,
    "pos_cash_balance": pos_cash_balance,
    "installments_payments": installments_payments,
}


def application(spark: SparkSession, sf_dir: str) -> DataFrame:
    return application_inputs(spark, sf_dir).join(planted_target(spark, sf_dir), "SK_ID_CURR")


def sources(spark: SparkSession, sf_dir: str, without: tuple[str, ...] = (), target: bool = True) -> dict[str, DataFrame]:
    app = application(spark, sf_dir) if target else application_inputs(spark, sf_dir)
    return {"application": app, **{n: f(spark, sf_dir) for n, f in SIDES.items() if n not in without}}
