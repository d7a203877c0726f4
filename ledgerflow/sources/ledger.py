"""Test-data adapter: ledger views over the given TPC-H-style tables.

No payments table ships with the test data, so the ledger is derived with
Spark from lineitem x orders (fact) and supplier x nation x region (merchant
dim).  The same mapping is written as SQL in ``plans/oracle.py`` for the
DuckDB oracle.  Everything downstream only sees these column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import money
from .tables import read_table, read_wide

# Fixed mapping values (adapter definition, shared with the oracle SQL).
STATUS_BY_RETURNFLAG = {"A": "COMPLETED", "R": "FAILED"}  # anything else -> PENDING
CREDIT_PRIORITIES = ("1-URGENT", "2-HIGH")
DEBIT_PRIORITY = "3-MEDIUM"
LEDGER_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31"


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transaction fact: one row per lineitem (ids repeat -> dedup work)."""
    li = read_wide(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_returnflag", "l_shipdate"])
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    status = (F.when(F.col("l_returnflag") == "A", "COMPLETED")
              .when(F.col("l_returnflag") == "R", "FAILED")
              .otherwise("PENDING"))
    method = (F.when(F.col("o_orderpriority").isin(*CREDIT_PRIORITIES), "CREDIT_CARD")
              .when(F.col("o_orderpriority") == DEBIT_PRIORITY, "DEBIT_CARD")
              .otherwise("UPI"))
    return j.select(
        F.concat(F.lit("TXN"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        money("l_extendedprice").alias("amount"),
        status.alias("status"),
        F.col("l_suppkey").alias("merchant_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("l_shipdate").alias("transaction_date"),
        method.alias("payment_method"),
        F.col("l_partkey").alias("src_seq"),
    )


def merchant_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All merchants with an ``is_active`` flag (s_acctbal >= 0)."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation (25 rows) and region (5 rows) are fixed-size TPC-H tables: one list of places, looked up per supplier. As a
    # join, the planner would take the product of the sizes for the merchants' and shuffle the ledger to them.
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).where("n_nationkey is not null")
    places = geo.agg(F.collect_list(F.struct("n_nationkey", "n_name", "r_name"))).scalar()
    own = F.filter("_places", lambda p: p["n_nationkey"] == F.col("s_nationkey"))
    return s.withColumn("_places", places).withColumn("_place", F.explode(own)).select(
        F.col("s_suppkey").alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        F.col("_place.r_name").alias("category"),
        F.col("_place.n_name").alias("city"),
        (F.col("s_acctbal") >= 0).alias("is_active"),
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered merchants only: the dim the ledger enriches against."""
    return (merchant_master(spark, sf_dir).where(F.col("is_active"))
            .select("merchant_id", "merchant_name", "category", "city"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_tier"),
        F.col("n_name").alias("city"),
        F.col("c_acctbal").alias("balance"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event stream table with ``ts`` as a session-zone TIMESTAMP (UTC)."""
    return read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def bronze_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw (Bronze) ledger rows as strings, with the merchant attributes a
    left join finds (NULL for unregistered merchants)."""
    t = transactions(spark, sf_dir).drop("src_seq")
    m = merchants(spark, sf_dir).select("merchant_id", "merchant_name", "city")
    j = t.join(m, "merchant_id", "left")
    cols = ["transaction_id", "amount", "status", "merchant_id", "customer_id", "transaction_date",
            "payment_method", "merchant_name", "city"]
    return j.select(*[F.col(c).cast("string").alias(c) for c in cols])


def dirty_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw ledger as a careless upstream would send it: ``bronze_enriched`` with a currency and a note, where
    each of the faults below hits one row in 400 (picked by the row's own keys) and a few rows come twice."""
    t = transactions(spark, sf_dir)
    m = merchants(spark, sf_dir).select("merchant_id", "merchant_name", "city")
    k = F.pmod(F.col("src_seq") * 31 + F.col("customer_id") * 7 + F.col("merchant_id"), F.lit(400))
    b = t.join(m, "merchant_id", "left").withColumn("k", k)

    def swap(column, *faults):
        out = F.col(column).cast("string")
        for n, value in faults:
            out = F.when(F.col("k") == n, value).otherwise(out)
        return out.alias(column)

    amount, date = F.col("amount").cast("string"), F.col("transaction_date").cast("string")
    comma = F.regexp_replace(amount, r"^(\d+)(\d{3}\.)", "$1,$2")
    b = b.withColumn("currency", F.when(F.pmod("customer_id", F.lit(5)) == 0, "USD").otherwise("INR"))
    b = b.withColumn("note", F.when(F.pmod("customer_id", F.lit(2)) == 0, "agreed"))
    rows = b.select(
        "k", "src_seq", swap("transaction_id", (0, F.lit("")), (1, F.lit(None))),
        swap("amount", (2, F.concat(F.lit("-"), amount)), (3, F.lit("0.00")), (4, comma), (5, F.lit(" ")), (6, F.lit("n/a")),
             (7, F.lit("99999999.00"))),
        swap("status", (11, F.lower("status")), (12, F.lit("REFUNDED"))),
        swap("merchant_id", (18, F.concat(F.lit("TEST_"), F.col("merchant_id").cast("string")))), F.col("customer_id").cast("string").alias("customer_id"),
        swap("transaction_date", (8, F.translate(date, "-", "/")), (9, F.lit("99-99-9999")), (10, F.lit("2090-05-05"))),
        "payment_method", swap("merchant_name", (13, F.lit(" "))), "city",
        swap("currency", (14, F.lit("IND")), (15, F.lit("XYZ")), (16, F.lit(None)), (17, F.lit("US$"))), "note")
    copies = F.sequence(F.lit(1), F.when(F.col("k") == 20, 2).otherwise(1))
    return rows.withColumn("copy", F.explode(copies)).drop("k", "copy")
