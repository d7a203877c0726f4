"""Incremental upkeep of the marts (B1, B2, S11, A3): a batch changes only what it touches.

The state under ``root`` is a log of the versions of each transaction that won, with a
key index (``sources.indexed``), and additive partials of the marts, one folder
a batch and span of dates. A batch looks its ids up in the parts that may hold them; for each id
whose version is later, the old one is retracted from the partials of its date
and the new one added to its own. Spans that nothing touches are neither read nor written.
The batch's marker, written last, makes versions and partials count at once: a batch cut off
halfway is applied anew, one that is marked is not applied again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import as_double, pct_or_zero
from ..session import ensure_checkpoint_dir
from ..sources.indexed import IndexedTable
from .gold import COMPLETED, FAILED
from .silver import LEDGER_DEDUP_ORDER, keep_latest, silver_filter

KEY = "transaction_id"
MONEY = "decimal(28,2)"
UNDATED = "none"


@dataclass(frozen=True)
class Partial:
    """Sums by ``keys`` and day; a group whose ``count`` is 0 is no more."""

    name: str
    keys: tuple[str, ...]
    sums: dict[str, str]  # SQL over one transaction
    count: str


AMOUNT = f"CAST(CASE WHEN status = '{COMPLETED}' THEN amount ELSE 0 END AS {MONEY})"
PARTIALS = (
    Partial("customer_days", ("customer_id", "payment_method"),
            {"txns": f"CAST(status = '{COMPLETED}' AS BIGINT)", "amount": AMOUNT}, "txns"),
    Partial("merchant_days", ("merchant_id",),
            {"txns": "1L", "failed": f"CAST(status = '{FAILED}' AS BIGINT)", "amount": AMOUNT}, "txns"),
)


class LedgerState:
    def __init__(self, spark: SparkSession, root: str, order: tuple[str, ...] = LEDGER_DEDUP_ORDER, span: str = "yyyy-MM"):
        """``span``: the dates that one folder of partials holds, as a date pattern; the same for the life of a state."""
        self.spark, self.root, self.order, self.pattern = spark, root.rstrip("/"), order, span
        self.versions = IndexedTable(spark, self.root, KEY)

    def _where(self, partial: str) -> dict[str, str]:
        """Span -> folder of its latest partials (one entry a span)."""
        out: dict[str, str] = {}
        for m in self.versions.markers():
            for span in m["spans"].get(partial, []):
                out[span] = f"{self.root}/{partial}/{m['part']}/span={span}"
            for span in m["emptied"].get(partial, []):
                out.pop(span, None)
        return out

    def partial(self, p: Partial, spans: list[str] | None = None) -> DataFrame | None:
        """The latest partials of all spans, or of those named; the folders of other spans are not opened."""
        paths = [x for span, x in self._where(p.name).items() if spans is None or span in spans]
        return self.spark.read.option("basePath", f"{self.root}/{p.name}").schema(self._schema(p)).parquet(*paths).select("span", "day", *p.keys, *p.sums) if paths else None

    def _schema(self, p: Partial) -> str:
        types = {"customer_id": "long", "merchant_id": "long", "payment_method": "string", "amount": MONEY}
        return ", ".join(f"{c} {types.get(c, 'long')}" for c in (*p.keys, *p.sums)) + ", day date, batch string, span string"

    def winners(self, batch: DataFrame) -> tuple[DataFrame, list[str]]:
        """Versions in the batch that are later than what is known of their ids, ``old`` the one they replace; and the parts read."""
        cols = batch.columns
        rows = silver_filter(batch)
        new = keep_latest(rows, KEY, self.order)
        parts = self.versions.may_hold(rows.select(KEY).distinct().checkpoint(eager=True)) if any(m["rows"] for m in self.versions.markers()) else []
        rank = F.struct(*self.order, *[c for c in cols if c not in self.order])
        if not parts:
            return new.withColumn("old", F.lit(None).cast(new.select(F.struct(*cols).alias("s")).schema["s"].dataType)), []
        # both sides are dealt by id when their latest versions are picked, and so meet without another shuffle
        known = keep_latest(self.versions.read(parts), KEY, self.order)
        known = known.select(F.col(KEY).alias("_id"), F.struct(*cols).alias("old"), rank.alias("_rank"))
        both = new.join(known, F.col(KEY) == F.col("_id"), "left")
        return both.where(F.col("_rank").isNull() | (rank > F.col("_rank"))).select(*cols, "old"), parts

    def apply(self, batch: DataFrame, name: str) -> dict:
        """Takes a batch of ledger rows in; returns its marker (``replayed`` if it was applied before)."""
        ensure_checkpoint_dir(self.spark)
        if (done := self.versions.marker(name)) is not None:
            return {**done, "replayed": True}
        won, parts = self.winners(batch)
        won = won.checkpoint(eager=True)
        change = won.drop("old").withColumn("sign", F.lit(1)).unionByName(won.where("old is not null").select("old.*").withColumn("sign", F.lit(-1)))
        day = F.col("transaction_date")
        change = change.withColumn("day", day).withColumn("span", F.coalesce(F.date_format(day, self.pattern), F.lit(UNDATED)))
        spans: dict[str, list[str]] = {}
        emptied: dict[str, list[str]] = {}
        for p in PARTIALS:
            by = ("span", "day", *p.keys)
            total = [F.sum(n).cast(MONEY if n == "amount" else "long").alias(n) for n in p.sums]
            delta = change.select(*by, *[(F.coalesce(F.expr(c), F.lit(0)) * F.col("sign")).alias(n) for n, c in p.sums.items()])
            delta = delta.where(" or ".join(f"{n} <> 0" for n in p.sums))
            touched = [r[0] for r in delta.select("span").distinct().collect()]  # spans at most
            known = self.partial(p, touched)
            merged = (delta if known is None else delta.unionByName(known)).groupBy(*by).agg(*total)
            path = f"{self.root}/{p.name}/{self.versions.part_of(name)}"
            merged.where(F.col(p.count) != 0).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("span").parquet(path)
            left = {r[0] for r in self.spark.read.schema(self._schema(p)).parquet(path).select("span").distinct().collect()} if touched else set()
            spans[p.name], emptied[p.name] = sorted(left), sorted(set(touched) - left)
        return self.versions.append(won.drop("old"), name, spans=spans, emptied=emptied, opened=parts)

    def customer_ltv(self) -> DataFrame | None:
        """A3 from the partials: one row a customer, day and method instead of the transactions."""
        p = self.partial(PARTIALS[0])
        if p is None:
            return None
        by = p.groupBy("customer_id", "payment_method").agg(F.sum("txns").alias("n"), F.sum("amount").alias("s"), F.min("day").alias("first"), F.max("day").alias("last"))
        n, s = F.sum("n"), F.sum("s")
        return by.groupBy("customer_id").agg(
            as_double(s).alias("total_spent"), n.alias("total_txns"), as_double(F.round((s / n).cast("decimal(22,6)"), 2)).alias("avg_txn_value"),
            F.min("first").alias("first_txn_date"), F.max("last").alias("last_txn_date"),
            F.min_by("payment_method", F.struct(-F.col("n"), "payment_method")).alias("preferred_payment_method"))

    def merchant_days(self) -> DataFrame | None:
        """A1 by merchant and date, without the merchant's attributes."""
        p = self.partial(PARTIALS[1])
        return None if p is None else p.select(
            "merchant_id", F.col("day").alias("report_date"), as_double(F.col("amount")).alias("total_revenue"), F.col("txns").alias("txn_count"),
            pct_or_zero(F.col("failed"), F.col("txns")).alias("failure_rate_pct"))
