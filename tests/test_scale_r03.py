"""Findings of round 3: what a query shuffles, and that whole results stay."""

import re
import zlib
from collections import defaultdict
from datetime import date, datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import nbest_pieces
from ledgerflow.llm.queries import tokenizer
from ledgerflow.operators import gold, marts
from ledgerflow.operators import quality as Q
from ledgerflow.operators.incremental import PARTIALS, LedgerState
from ledgerflow.operators.repair_loop import repair_loop
from ledgerflow.plans.catalog import REGISTRY
from explain_plans import plan_text
from ledgerflow.sources import ledger
from ledgerflow.streaming import ops
from tests.conftest import SF_SMALL


def test_f1_every_segmentation_is_decoded_whole(monkeypatch):
    m = nbest_pieces.Lattice(tokenizer("piece_bpe_32k.model"))
    text, seen = "the cat über 漢\U0001f600 there\x07", []
    whole = m.decoded
    monkeypatch.setattr(m, "decoded", lambda ids: seen.append(whole(ids)) or seen[-1])
    assert [x[3] for x in m.encode(text)] == [True] * 3 and seen == ["".join(m.words(text))] * 3
    assert all(m.decode(ids.tolist()) == m.decoded(ids) for ids in (np.arange(len(m.pieces)), np.arange(0)))
    monkeypatch.setattr(m, "decoded", lambda ids: whole(ids[:-1]))  # a decoder that loses a piece is found out
    assert not any(x[3] for x in list(m.encode_all([text]))[0])


class _Counted(dict):
    looks = 0

    def get(self, *key):
        self.looks += 1
        return super().get(*key)

    def __getitem__(self, key):
        self.looks += 1
        return super().__getitem__(key)


def test_op5_each_distinct_word_is_looked_up_once(monkeypatch):
    m = nbest_pieces.Lattice(tokenizer("piece_bpe_32k.model"))
    texts = ["the cat\nsat on the mat \x07 über"] * 50 + [None, "", "\n", "▁", "a  b"]
    want = [m.encode(t or "") for t in texts]
    m.known, best = _Counted(), []
    monkeypatch.setattr(m, "best", lambda w: best.append(w))  # words with unknown characters too are learnt together
    assert list(m.encode_all(texts)) == want and not best
    assert m.known.looks <= len(m.known)
    assert list(m.encode_all([None, ""])) == [m.encode("")] * 2 and list(m.encode_all([])) == []


def test_op5_against_every_segmentation_of_the_vocabulary():
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    size = range(sp.get_piece_size())
    byte = {int(sp.id_to_piece(k)[3:-1], 16): k for k in size if sp.is_byte(k)}
    piece = {sp.id_to_piece(k): k for k in size if not (sp.is_byte(k) or sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k))}
    low = min(s for s in map(sp.get_score, piece.values()) if s > -1e8) - nbest_pieces.UNKNOWN  # pieces never merged aside

    def every(s):
        if not s:
            yield 0.0, ()
        for z in range(1, len(s) + 1):
            if s[:z] in piece:
                yield from ((x + sp.get_score(piece[s[:z]]), (piece[s[:z]], *ids)) for x, ids in every(s[z:]))
        if s and s[0] not in piece:
            yield from ((x + low, (*(byte[b] for b in s[0].encode()), *ids)) for x, ids in every(s[1:]))

    m = nbest_pieces.Lattice(tokenizer("piece_bpe_32k.model"))
    texts = ["hello you", "a\nb", "x\U0001f600\n\n\x07y z", "über\nan", "\n", "one  two", "q"]
    for text, got in zip(texts, m.encode_all(texts), strict=True):
        found = sorted(every(sp.normalize(text)), reverse=True)
        assert [x[0] for x in got] == [x for x, _ in found[:3]], text
        for s, n, crc, decoded in got:
            assert decoded and (n, crc) in {(len(ids), zlib.crc32(np.array(ids, "<u4"))) for x, ids in found if x == s}, text


def test_op5_batches_are_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(nbest_pieces, "TOGETHER", 10)
    for texts in (["12345", "67890", None, "", "漢漢漢漢", "x" * 50, "", "1"], [], [None, None], ["x" * 11]):
        b = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["id", "text"])
        parts = [x.column(1).to_pylist() for x in nbest_pieces._slices(b)]
        assert sum(parts, []) == texts and all(len(x) == 1 or sum(len((t or "").encode()) for t in x) <= 10 for x in parts)


def _row_exchanges(df) -> list[str]:
    return re.findall(r"Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan_text(df))


@pytest.mark.parametrize("name", ["q14_quarantine_dirty", "q14_quarantine_split", "q16_load_decision", "q20_issue_counts", "q20_issue_classes"])
def test_f5_f6_f8_f10_f11_rows_are_shuffled_with_one_key(spark, name):
    inputs = _row_exchanges(REGISTRY[name].build(spark, SF_SMALL))
    keyed = [i for i in inputs if "__salt" in i]
    assert keyed and not any("__key_" in i and "__salt_" in i for i in inputs)
    if name[:3] != "q14":  # key, salt and one number
        assert all(len(i.split(", ")) <= 3 for i in keyed)


def test_f5_merchants_are_estimated_by_their_own_size(spark):
    size = ledger.merchants(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(size) < 10_000_000


def test_duplicate_flags_beside_other_checks(spark):
    rows = [(i, s) for i, n in (("a", 1), ("b", 2), (None, 3), ("", 2)) for s in "XY"[:n] or "X"] + [(None, "Z"), ("c", "Z")]
    df = spark.createDataFrame(rows, "id string, s string")
    checks = [Q.unique("id"), Q.in_set("s", ["X", "Y"])]
    got = Q.split_counts(df, checks).first()
    counts = {i: sum(r[0] == i for r in rows) for i, _ in rows}
    bad = sum(counts[i] > 1 or s == "Z" for i, s in rows)
    assert tuple(got) == (len(rows) - bad, bad)
    assert Q.quarantine_split(df, checks, "2024-01-01 00:00:00")[1].count() == bad


def test_f4_daily_revenue_without_texts_in_groups(spark):
    assert "Aggregate" in (text := plan_text(REGISTRY["b4_fct_daily_revenue"].build(spark, SF_SMALL)))
    for keys in re.findall(r"HashAggregate\nInput \[\d+\]: \[(.*?)\]", text):
        assert not ("merchant_name" in keys and "transaction_date" in keys)
    txn = spark.createDataFrame([("a", date(2024, 1, 1), 1, "COMPLETED", 5), ("b", date(2024, 1, 1), 1, "FAILED", 7), ("c", date(2024, 1, 1), 2, "COMPLETED", 1),
                                 ("d", date(2024, 1, 1), None, "COMPLETED", 1), ("e", None, 2, "FAILED", 2)], "transaction_id string, transaction_date date, merchant_id long, status string, amount int")
    txn = txn.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    dim = spark.createDataFrame([(1, "m", "c"), (1, "m", "c"), (1, "other", "c"), (2, "n", None), (None, "x", "y")], "merchant_id long, merchant_name string, category string")
    got = {(str(r.transaction_date), r.merchant_name): (r.transaction_count, int(r.gmv), int(r.failed_amount), r.failed_count, r.failure_rate_pct) for r in gold.daily_gmv(txn, dim).collect()}
    assert got == {("2024-01-01", "m"): (4, 10, 14, 2, 50.0), ("2024-01-01", "other"): (2, 5, 7, 1, 50.0), ("2024-01-01", "n"): (1, 1, 0, 0, 0.0), ("None", "n"): (1, 0, 2, 1, 100.0)}
    days = {str(r.transaction_date): r.active_merchants for r in marts.daily_revenue(gold.daily_gmv(txn, dim)).collect()}
    assert days == {"2024-01-01": 2, "None": 1}


def test_f7_sliding_windows_whole(spark):
    t0 = datetime(2024, 1, 1)
    rows = [(t0 + timedelta(minutes=(k * 37) % 900, seconds=k % 60), k % 3 or None, None if k % 7 == 0 else k % 11 - 4.5) for k in range(300)] + [(None, 1, 2.0), (t0 + timedelta(days=9), 7, None)]
    df = spark.createDataFrame(rows, "ts timestamp, user_id int, value double")
    want = defaultdict(list)
    for ts, u, v in rows:
        b = ts and ts - timedelta(minutes=ts.minute % 5, seconds=ts.second)
        for k in range(48 if ts else 0):
            want[b - timedelta(minutes=5 * k), u].append(v)
    got = {(r.window_start, r.user_id): r for r in ops.sliding(df, "ts", "4 hours", "5 minutes", ["user_id"]).collect()}
    assert got.keys() == want.keys()
    for k, vs in want.items():
        some = [v for v in vs if v is not None]
        assert got[k].events == len(vs) and got[k].window_end - k[0] == timedelta(hours=4)
        assert got[k].value_sum == (pytest.approx(sum(some), abs=0.011) if some else None)
    assert "Expand" not in plan_text(ops.sliding(df, "ts", "4 hours", "5 minutes", ["user_id"]))


def test_f2_f3_spans_are_written_by_many_tasks(spark, tmp_dir):
    cols = "transaction_id string, amount decimal(18,2), status string, merchant_id long, customer_id long, transaction_date date, payment_method string, src_seq long"
    rows = spark.range(20_000).selectExpr("concat('T', id) AS transaction_id", "CAST(1 AS DECIMAL(18,2)) AS amount", "'COMPLETED' AS status", "id AS merchant_id",
                                          "id AS customer_id", "DATE '2024-01-01' AS transaction_date", "'UPI' AS payment_method", "id AS src_seq")
    assert rows.schema.names == [c.split()[0] for c in cols.split(", ")]
    state = LedgerState(spark, f"{tmp_dir}/state", span="yyyy")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        state.apply(rows, "a")
        state.apply(rows.withColumn("src_seq", F.col("src_seq") + 1).where("customer_id < 10"), "b")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    part = state.partial(PARTIALS[0])
    assert len(part.inputFiles()) > 1 and part.count() == 20_000 and state.customer_ltv().agg(F.sum("total_txns")).first()[0] == 20_000


def test_f9_the_plan_of_the_rows_runs_once(spark, tmp_dir):
    ran = spark.sparkContext.accumulator(0)

    def see(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b
    rows = spark.createDataFrame([("T1", "1"), (None, "2"), ("T3", "x")], "transaction_id string, amount string").mapInArrow(see, "transaction_id string, amount string")
    checks = [Q.not_null("transaction_id"), Q.between("amount", 0, 10)]
    out, _state = repair_loop(rows, checks, {(c.label, c.column): [("drop_bad_rows", None)] for c in checks}, tmp_dir)
    assert ran.value == 3
