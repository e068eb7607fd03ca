"""Raw sales records derived from the order tables used for tests.

Every order line becomes one all-text sales record. Defects are placed by the
remainder of a row key, so they are the same on every run and in every engine.
The joins are plain equi-joins on keys: small sides are broadcast by the
optimizer when their files are below its threshold, and skewed keys are split
by adaptive execution. Orders meet their buyers first, so that the lines, of
which there are most, travel for their part and their order alone, with the day
they were shipped and the billed amount only where a record shows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallybook.config import INVALID_TOKENS_V1, Vocabulary
from tallybook.schemas import RAW_COLUMNS

SAMPLE = Vocabulary(
    items=("Standard", "Promo", "Economy", "Medium", "Small", "Large"),
    payments=("Urgent", "High", "Medium", "Not Specified", "Low"),
    locations=("Africa", "America", "Asia", "Europe", "Middle East"),
    payment_aliases={"1-urgent": "Urgent", "2-high": "High", "3-medium": "Medium",
                     "4-not specified": "Not Specified", "5-low": "Low"},
    location_aliases={"middle-east": "Middle East"},
)

# The older rules know fewer values of each category.
SAMPLE_V1 = Vocabulary(
    items=("Standard", "Promo", "Economy", "Medium", "Small"),
    payments=("Urgent", "High", "Medium", "Not Specified"),
    locations=("Africa", "America", "Asia", "Europe"),
    invalid_tokens=INVALID_TOKENS_V1,
    payment_aliases={"1-urgent": "Urgent", "2-high": "High", "3-medium": "Medium",
                     "4-not specified": "Not Specified"},
)

# Share of revenue that is cost; items not listed take the default rate.
SAMPLE_COST_RATES = {"Standard": "0.60", "Promo": "0.66", "Economy": "0.63",
                     "Medium": "0.58", "Small": "0.72"}

# Cost rates from a day on; Standard has none, Medium two on the same day.
SAMPLE_DATED_RATES = [
    ("Promo", "1993-01-01", "0.66"), ("Promo", "1995-06-15", "0.61"), ("Promo", "1997-02-28", "0.70"),
    ("Economy", "1994-03-01", "0.63"), ("Medium", "1992-01-01", "0.58"), ("Medium", "1996-08-09", "0.55"),
    ("Medium", "1996-08-09", "0.57"), ("Small", "1998-12-31", "0.72"), ("Large", "1996-01-01", "0.64"),
]

EXTRA_COLUMNS = ("order_type", "customer_id")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """All-text sales records with order type and customer as extra columns."""
    buyers = (
        _table(spark, folder, "customer")
        .join(_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_mktsegment", "r_name")
    )
    orders = (
        _table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    )
    parts = _table(spark, folder, "part").select("p_partkey", "p_type", "p_retailprice")
    key = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13
           + F.col("l_partkey") * 31 + F.col("l_suppkey") * 3)

    def rest(n: int, of: Column = F.col("k")) -> Column:
        return F.pmod(of, F.lit(n))

    lines = _table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        F.when(rest(17, key) == 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"))

    joined = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("k", key)
    )

    count = F.col("l_quantity").cast("bigint")
    price = F.col("p_retailprice").cast("decimal(12,2)")
    amount = (count.cast("decimal(12,0)") * price).cast("decimal(18,2)")

    day = F.date_format("l_shipdate", "yyyy-MM-dd")

    records = joined.select(
        F.concat_ws("_", F.lit("TXN"), "l_orderkey", "l_linenumber", "l_partkey",
                    "l_suppkey").alias("transaction_id"),
        F.when(rest(19) == 0, F.lit(None))
        .when(rest(19) == 1, F.lit("ERROR"))
        .when(rest(19) == 2, F.lit(" UNKNOWN "))
        .when(rest(19) == 3, F.concat(F.lit("  "), F.lower("p_type"), F.lit(" ")))
        .when(rest(19) == 4, F.lit("Gadget"))
        .otherwise(F.col("p_type")).alias("item"),
        F.when(rest(29) == 0, F.lit(None))
        .when(rest(29) == 1, F.lit("ERROR"))
        .when(rest(29) == 2, F.lit("abc"))
        .when(rest(29) == 3, F.concat(F.lit("\u00a0"), count.cast("string"), F.lit(" ")))
        .otherwise(count.cast("string")).alias("quantity"),
        F.when(rest(31) == 0, F.lit("UNKNOWN"))
        .when(rest(31) == 1, F.lit(""))
        .when(rest(31) == 2, F.concat(F.lit(" "), price.cast("string"), F.lit("\t")))
        .otherwise(price.cast("string")).alias("price_per_unit"),
        F.when(rest(17) == 0, F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
        .when(rest(17) == 1, F.lit("ERROR"))
        .when(rest(17) == 2, F.concat(F.lit("\t"), amount.cast("string")))
        .otherwise(amount.cast("string")).alias("total_spent"),
        F.when(rest(3) == 0, F.lit("UNKNOWN"))
        .otherwise(F.col("o_orderpriority")).alias("payment_method"),
        F.when(rest(5).isin(0, 1), F.lit(None))
        .when(rest(5) == 2, F.lower(F.translate("r_name", " ", "-")))
        .otherwise(F.col("r_name")).alias("location"),
        F.when(rest(23) == 0, F.lit("ERROR"))
        .when(rest(46) == 1, F.lit("2023-02-30"))
        .when(rest(37) == 0, F.concat(F.lit(" "), day, F.lit("\t")))
        .when(rest(37) == 1, F.concat(F.lit("\u00a0"), day))
        .otherwise(day)
        .alias("transaction_date"),
        F.col("c_mktsegment").alias("order_type"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        # Some records arrive twice.
        F.explode(F.when(rest(41) == 0, F.array(F.lit(1), F.lit(2)))
                  .otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return records.select(*RAW_COLUMNS, *EXTRA_COLUMNS)
