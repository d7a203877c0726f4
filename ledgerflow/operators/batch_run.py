"""B1: one daily Bronze -> Silver -> Gold run with writes, the 5 % halt gate
(Q17), empty-input guards (S20), missing-source skip (S19) and a run record
(S17) whose stage counts come from observations on the write jobs."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from . import gold, silver

BRONZE_COLUMNS = ["transaction_id", "amount", "status", "merchant_id", "customer_id", "transaction_date",
                  "payment_method"]


def type_bronze(bronze: DataFrame) -> DataFrame:
    """Bronze strings -> typed rows (try_cast: junk becomes NULL, then filtered)."""
    return bronze.select(
        "transaction_id",
        F.expr("try_cast(amount AS DECIMAL(18,2))").alias("amount"),
        F.upper(F.trim("status")).alias("status"),
        "merchant_id", "customer_id",
        F.expr("try_to_date(transaction_date, 'yyyy-MM-dd')").alias("transaction_date"),
        F.upper(F.trim("payment_method")).alias("payment_method"),
        F.col("ingestion_timestamp"),
    )


def run_daily(spark: SparkSession, source_csv: str, merchants: DataFrame, out_root: str, run_date: str,
              run_id: str, run_ts: str, halt_share: float = 0.05) -> dict:
    """Process one run date.  Bronze is partitioned by run date, Silver and Gold by
    transaction date.  Silver of every date that the run touches (late rows included) is
    derived anew from all Bronze rows of the ids concerned, so nothing that earlier
    runs loaded is lost and the latest ingestion of an id wins across runs; Gold of those
    dates follows, lifetime value is taken over all of Silver.  A rerun replaces its own
    date only.  Appends one JSON run record under runs/."""
    started = _dt.datetime.now(_dt.timezone.utc).isoformat()
    rec = {"pipeline_name": "ledger_daily", "run_date": run_date, "run_id": run_id, "status": "SUCCESS",
           "error": None, "start_time": started}
    if not files.path_exists(spark, source_csv):                     # S19
        rec.update(status="SKIPPED", error=f"source missing: {source_csv}")
        return _finish(spark, out_root, rec, {})
    counter = files.StageCounter()
    raw = files.read_bronze_csv(spark, source_csv, BRONZE_COLUMNS)
    if raw.isEmpty():                                                          # S20: nothing is written
        rec.update(status="FAILED", error="E001: the source has no rows")
        return _finish(spark, out_root, rec, counter.counts())
    bronze = files.with_ingest_metadata(raw, run_id, run_ts).withColumn("date", F.lit(run_date))
    files.write_partitioned(counter.tap(bronze, "bronze_in"), f"{out_root}/bronze", "date")

    b = files.read_partition(spark, f"{out_root}/bronze", "date", run_date)   # S4 pruned read
    typed = type_bronze(b)
    stats = typed.agg(F.count(F.lit(1)).alias("n"),
                      F.count_if(F.col("transaction_id").isNull() | F.col("amount").isNull()
                                 | (F.col("amount") < 0) | F.col("transaction_date").isNull()).alias("bad")).first()
    share = (stats["bad"] / stats["n"]) if stats["n"] else 0.0
    rec["failed_share"] = round(share, 6)
    if share > halt_share:                                                     # Q17 halt gate
        rec.update(status="HALTED", error=f"{share:.2%} of rows failed checks (> {halt_share:.0%})")
        return _finish(spark, out_root, rec, counter.counts())

    # all dates that rows of this run's ids have, in this run or before
    every = type_bronze(spark.read.parquet(f"{out_root}/bronze")).where("transaction_date is not null")
    ids = typed.select("transaction_id").where("transaction_id is not null").distinct()
    dates = every.join(ids, "transaction_id", "left_semi").select("transaction_date").distinct()
    concerned = every.join(every.join(dates, "transaction_date", "left_semi").select("transaction_id").distinct(),
                           "transaction_id", "left_semi")
    # keep-latest by ingestion time, then the full column list as tie-break
    filtered = silver.silver_filter(concerned.withColumn("src_seq", F.lit(0)))
    latest = silver.keep_latest(filtered, "transaction_id", ["ingestion_timestamp", "transaction_date", "amount"])
    enriched = silver.enrich(latest.join(dates, "transaction_date", "left_semi"), merchants, "merchant_id",
                             ["merchant_name", "category", "city"])
    silver_df = counter.tap(enriched.select(*silver.SILVER_COLUMNS), "silver_out").withColumn(
        "date", F.col("transaction_date").cast("string"))
    files.write_partitioned(silver_df, f"{out_root}/silver", "date")
    kept = spark.read.parquet(f"{out_root}/silver").select("date").distinct()
    left = enriched.select(F.col("transaction_date").cast("string").alias("date")).distinct()
    emptied = dates.select(F.col("transaction_date").cast("string").alias("date")).join(left, "date", "left_anti")
    for r in emptied.join(kept.select(F.col("date").cast("string")), "date", "left_semi").collect():
        for part in ("silver", "gold/merchant_performance", "gold/daily_summary"):  # dates whose rows all moved
            files.delete_path(spark, f"{out_root}/{part}/date={r['date']}")

    whole = spark.read.parquet(f"{out_root}/silver")
    s = whole.join(dates, "transaction_date", "left_semi")
    perf = gold.merchant_performance(s, by_date=True).withColumn("date", F.col("report_date").cast("string"))
    files.write_partitioned(counter.tap(perf, "gold_merchant_performance"), f"{out_root}/gold/merchant_performance", "date")
    daily = gold.daily_summary(s).withColumn("date", F.col("report_date").cast("string"))
    files.write_partitioned(counter.tap(daily, "gold_daily_summary"), f"{out_root}/gold/daily_summary", "date")
    ltv = gold.customer_ltv(whole).withColumn("date", F.lit(run_date))
    files.write_partitioned(counter.tap(ltv, "gold_customer_ltv"), f"{out_root}/gold/customer_ltv", "date")
    return _finish(spark, out_root, rec, counter.counts())


def _finish(spark: SparkSession, out_root: str, rec: dict, counts: dict) -> dict:
    rec["end_time"] = _dt.datetime.now(_dt.timezone.utc).isoformat()
    rec["row_counts"] = counts
    files.write_run_metadata(spark, f"{out_root}/runs", rec)
    return rec
