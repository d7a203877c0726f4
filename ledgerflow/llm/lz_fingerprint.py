"""Lempel-Ziv phrase fingerprints.

A text is parsed into the phrases of an incremental dictionary: each is the
longest known phrase at its place and one character more. (An edited text
begins with half of its original, so its parse goes on from there.) The phrases'
hashes are a set; its minimum hashes under 128 permutations, 16 bits of each, are
the fingerprint. Texts that share much of their dictionaries, and so compress
well together, agree in many places.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as W
from .common import NULL_ID, partitions

SIZE = 128
_rng = np.random.default_rng(0x4C5A)
_A = _rng.integers(0, 2**31, SIZE, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 2**32, SIZE, dtype=np.uint32)[:, None]
_BASE = 0xC2B2AE3D27D4EB4F


def phrases(text: np.ndarray, known: dict[int, int] | None = None, width: int = 0) -> np.ndarray:
    """Where the phrases of a text (code points) end.

    The dictionary maps (number of a phrase * width + next character) to the
    longer phrase's number * width, in order of the numbers; ``known`` continues an earlier one.
    """
    known = {} if known is None else known
    width = width or _width(text)
    node, new, before, put = 0, (len(known) + 1) * width, len(known), known.setdefault
    for c in text.tolist():
        node = put(node + c, new)
        if node == new:
            new += width
            node = 0
    # a phrase is one longer than its parent: lengths by doubling the steps up the tree
    up = np.zeros(len(known) + 1, np.int64)
    up[1:] = np.fromiter(known, np.int64, len(known)) // width
    size = np.ones(len(up), np.int64)
    size[0] = 0
    while up.any():
        size += size[up]
        up = up[up]
    ends = np.cumsum(size[before + 1:])
    return np.append(ends, len(text)) if node else ends  # the last phrase may be one already known


def _width(text: np.ndarray) -> int:
    return int(text.max()) + 1 if len(text) else 1


def _lowest(text: np.ndarray, ends: np.ndarray, first: int = 0) -> np.ndarray:
    """Minimum of each permutation over the hashes of the phrases text[first:ends[0]], text[ends[0]:ends[1]], ..."""
    low = np.full((SIZE, 1), 2**32 - 1, np.uint32)
    if len(ends):
        part = text[first:ends[-1]].astype(np.uint64) + np.uint64(1)
        h = (W.spans(part, _BASE, np.concatenate([[0], ends[:-1] - first]), ends - first) >> np.uint64(32)).astype(np.uint32)
        for k in range(0, len(h), 256):
            x = _A * h[None, k:k + 256]
            x += _B
            np.minimum(low, x.min(1, keepdims=True), out=low)
    return low[:, 0]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _mark(low: np.ndarray) -> np.ndarray:
    return (low >> np.uint32(16)).astype(">u2")


def fingerprint(text: str) -> np.ndarray:
    """128 minimum hashes of the phrase set, 16 bits each; all ones for an empty text."""
    p = _points(text)
    return _mark(_lowest(p, phrases(p)))


class Parsed:
    """A text's fingerprint, and what the parse of its edited form can take over from it."""

    def __init__(self, text: str):
        self.text, self.points = text, _points(text)
        self.keep = len(text) - len(text) // 2
        self.known: dict[int, int] = {}
        ends = phrases(self.points, self.known)
        self.shared = int(np.searchsorted(ends, self.keep, "right"))  # phrases within the kept part
        if self.shared == len(ends):
            self.shared = max(0, len(ends) - 1)  # the last may be a phrase cut short
        self.at = int(ends[self.shared - 1]) if self.shared else 0
        self.low = _lowest(self.points, ends[:self.shared])
        self.mark = _mark(np.minimum(self.low, _lowest(self.points, ends[self.shared:], self.at)))

    def edited_mark(self, new: str) -> np.ndarray:
        """The fingerprint of ``new``, which begins like the text up to ``keep``."""
        p = _points(new)
        old, width = _width(self.points), max(_width(self.points), _width(p))
        keys = np.fromiter(self.known, np.int64, len(self.known))[:self.shared]
        keys = keys // old * width + keys % old
        known = dict(zip(keys.tolist(), range(width, (self.shared + 1) * width, width), strict=True))
        return _mark(np.minimum(self.low, _lowest(p[self.at:], phrases(p[self.at:], known, width))))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many first characters of the other, or by all it has."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of block and id; each is finished when its follower comes."""
    held, block = None, None
    out: list[tuple] = []
    for b in batches:
        for at, id_, text, copy in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            text = text or ""
            now = Parsed(text)
            if held is not None and at == block:
                own, was = held
                new = edited(was.text, text)
                mark = was.mark if new == was.text else was.edited_mark(new)
                out.append((own, len(was.text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), was.mark.tobytes().hex(), mark.tobytes().hex(),
                            likeness(was.mark, mark), likeness(was.mark, now.mark)))
            held, block = (None if copy else (id_, now)), at
            if len(out) >= 1000:
                yield _rows(out)
                out = []
    if out:
        yield _rows(out)


_SCHEMA = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], names=[x.split(" ")[0] for x in _SCHEMA.split(", ")])


def lz_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", blocks: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited form, and how near they are.

    The edited form has its last half replaced by the beginning of the next
    document by id; after the last comes the first. A null text counts as
    empty; two empty texts have likeness 1. A null id comes first and stays null; rows with the
    same id follow each other by their texts' order. A lone row is its own next. Other
    columns are not read; an empty table gives an empty result.

    One shuffle deals the texts to ``blocks`` ranges of ids (as many as
    shuffle partitions), and the first row of each also to the range before.
    """
    spark = docs.sparkSession
    many = blocks or partitions(spark)
    rows = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(text).alias("text"))
    ids = rows.select("id")
    marks = ids.agg(F.percentile_approx("id", [k / many for k in range(1, many)] or [0.5], 100 * many).alias("q")).first()["q"]
    if marks is None:
        return spark.createDataFrame([], _SCHEMA).withColumnRenamed("id", id)
    bounds = np.unique(np.array(marks, np.int64)) if many > 1 else np.zeros(0, np.int64)

    @F.pandas_udf("int")
    def block_of(k):
        import pandas as pd
        return pd.Series(np.searchsorted(bounds, k.to_numpy(), "right").astype(np.int32))

    # the first id of each range: as many rows as blocks
    firsts = sorted((r["b"], r["i"]) for r in ids.select(block_of("id").alias("b"), "id").groupBy("b").agg(F.min("id").alias("i")).collect())
    before = {i: firsts[k - 1][0] for k, (_, i) in enumerate(firsts)}  # the first of all follows the last
    first = rows.where(F.col("id").isin([i for _, i in firsts])).groupBy("id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    copies = first.select(F.element_at(F.create_map(*[F.lit(x) for p in before.items() for x in p]), F.col("id")).cast("int").alias("b"), "id", "text", F.lit(True).alias("copy"))
    dealt = rows.select(block_of("id").alias("b"), "id", "text", F.lit(False).alias("copy")).unionByName(copies)
    out = (dealt.repartition(many, "b").sortWithinPartitions("b", "copy", "id", "text").mapInArrow(_stream, _SCHEMA))
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias(id), *[x.split(" ")[0] for x in _SCHEMA.split(", ")[1:]])
