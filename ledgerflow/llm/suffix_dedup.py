"""Substring dedup by prefix-partitioned suffix trees over words.

A symbol is a hashed run of four words, so a suffix cut at 20 words is five
symbols. Prefixes of one to five symbols, as long as each needs to be, split
the suffixes into groups that fit in memory. A group's tree is its sorted
suffixes with the lengths of their common prefixes; inner nodes of depth five
are windows that occur more than once, and every place below one but its first
starts a repeat.

Two exact savings come first. A suffix can only repeat if the window's
smallest 8-word hash does, so a bitmap of those that occur twice keeps most
suffixes out. And of equal windows of one batch only the first is sent on: the
others are repeats already.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import wordhash as W
from .common import NULL_ID, bitmap, cut, groups, in_bitmap, partitions

SYMBOL, DEPTH, ANCHOR = 4, 5, 8
WINDOW = SYMBOL * DEPTH
BINS = 1 << 14
CHUNK = 2500  # texts whose suffixes a task holds at a time
RECORD = np.dtype([("s", "<u4", DEPTH), ("at", "<u4"), ("text", "<u4"), ("doc", "<i8")])
PLACE = np.dtype([("at", "<u4"), ("text", "<u4"), ("doc", "<i8")])


def _anchors(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all windows, each one's smallest 8-word hash, and its 8-word hashes."""
    g, at, first = w.grams(ANCHOR)
    span = WINDOW - ANCHOR + 1
    if len(g) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    low = g.copy()
    step = 1
    while step < span:  # sliding minimum by doubling
        k = min(step, span - step)
        low = np.minimum(low[:-k], low[k:])
        step += k
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(g))
    ok = np.flatnonzero(left[:len(low)] >= span)
    return at[ok], low[ok], np.lib.stride_tricks.sliding_window_view(g, span)[ok]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, CHUNK):
            yield b.slice(k, CHUNK)


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of the batch; ``twice`` if it has one in two places."""
    for b in _chunks(batches):
        found = []
        for _, _, data, at in W.slices(b.column(1)):
            place, low, view = _anchors(W.words(data, at))
            if len(low):
                where = place + (view == low[:, None]).argmax(1)
                new = np.ones(len(low), bool)
                new[1:] = where[1:] != where[:-1]
                found.append(low[new])
        if not found:
            continue
        h, n = np.unique(np.concatenate(found), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n > 1)], names=["h", "twice"])


def _suffixes(b: pa.RecordBatch, seen: np.ndarray, bits: int) -> np.ndarray:
    """The batch's suffixes that may repeat, sorted."""
    out = []
    ids = b.column(0).to_numpy()
    for a, z, data, at in W.slices(b.column(1)):
        w = W.words(data, at)
        place, low, _ = _anchors(w)
        place = place[in_bitmap(seen, bits, low)]
        if not len(place):
            continue
        g, where, _ = w.grams(SYMBOL)
        back = np.zeros(len(w.hash) + 1, np.int64)
        back[where] = np.arange(len(where))
        r = np.zeros(len(place), RECORD)
        for k in range(DEPTH):
            r["s"][:, k] = (g[back[place + k * SYMBOL]] >> np.uint64(32)).astype(np.uint32)
        doc = np.searchsorted(w.bounds, place, "right") - 1
        r["at"], r["doc"], r["text"] = place - w.bounds[doc], ids[a:z][doc], _text_hash(w)[doc]
        out.append(r)
    return _sorted(np.concatenate(out) if out else np.zeros(0, RECORD))


def _text_hash(w: W.Words) -> np.ndarray:
    """Tells rows of one id apart."""
    return w.whole()[0] >> np.uint64(32)


def _sorted(r: np.ndarray) -> np.ndarray:
    return r[np.lexsort([r["at"], r["doc"], *(r["s"][:, k] for k in reversed(range(DEPTH)))])]


def depths(sorted_suffixes: np.ndarray) -> np.ndarray:
    """Symbols that each sorted suffix shares with the one before (0 for the first): the tree's inner nodes."""
    s = sorted_suffixes["s"]
    out = np.zeros(len(s), np.int64)
    if len(s) > 1:
        differ = s[1:] != s[:-1]
        out[1:] = np.where(differ.any(1), differ.argmax(1), DEPTH)
    return out


def repeats(r: np.ndarray) -> np.ndarray:
    """Which of the sorted suffixes lie under a node of full depth and start later than its first."""
    deep = depths(r) == DEPTH
    first = np.maximum.accumulate(np.where(deep, 0, np.arange(len(r))))
    return deep & ((r["doc"] != r["doc"][first]) | (r["at"] != r["at"][first]))


def _prefix(r: np.ndarray, length: int) -> np.ndarray:
    h = np.full(len(r), length, np.uint64)
    for k in range(length):
        h = W.mix(h * np.uint64(0x9E3779B97F4A7C15) + r["s"][:, k])
    return h


def _pack(groups_of: np.ndarray, r: np.ndarray, kind: int) -> pa.RecordBatch:
    order = np.argsort(groups_of, kind="stable")
    g, r = groups_of[order], r[order]
    at = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1, [len(g)]]) if len(g) else np.zeros(1, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(g[at[:-1]], pa.int64()), pa.array(np.full(len(at) - 1, kind), pa.int32()),
                                       pa.array([r[a:z].tobytes() for a, z in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["g", "kind", "r"])


def _place(r: np.ndarray, many: int, kind: int = 1) -> pa.RecordBatch:
    """Places of repeats, packed by group of documents."""
    out = np.zeros(len(r), PLACE)
    for k in PLACE.names:
        out[k] = r[k]
    return _pack((W.mix(out["doc"].view(np.int64).astype(np.uint64)) % np.uint64(many)).astype(np.int64), out, kind)


def _trees(many: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (g, kind), t in groups(batches, ["g", "kind"]):
            if kind:  # places already
                yield pa.RecordBatch.from_arrays([pa.array([int(g)]), pa.array([b"".join(t["r"].to_pylist())], pa.binary())], names=["g", "r"])
            else:
                r = _sorted(np.frombuffer(b"".join(t["r"].to_pylist()), RECORD))
                yield _place(r[repeats(r)], many).select(["g", "r"])
    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text: its id, the hash of its words, and where its repeated windows start."""
    for _, t in groups(batches, ["g"]):
        r = np.frombuffer(b"".join(t["r"].to_pylist()), PLACE)
        if len(r):
            r = r[np.lexsort([r["at"], r["text"], r["doc"]])]
            at = np.concatenate([[0], np.flatnonzero((r["doc"][1:] != r["doc"][:-1]) | (r["text"][1:] != r["text"][:-1])) + 1, [len(r)]])
            yield pa.RecordBatch.from_arrays([pa.array(r["doc"][at[:-1]]), pa.array(r["text"][at[:-1]].astype(np.int64)),
                                              pa.array([r["at"][a:z].tobytes() for a, z in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["id", "h", "starts"])


def _split(batch_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of equal suffixes, and those that repeat within the batch."""
    later = repeats(batch_rows)
    again = depths(batch_rows) == DEPTH
    return batch_rows[~again], batch_rows[later]


def repeated_windows(docs: DataFrame, id: str = "doc_id", text: str = "text", bits: int = 26, group: int = 250_000) -> DataFrame:
    """``id, h, starts``: the places (little-endian 32-bit words) of windows of 20
    words that also start earlier, for each text that has some; a text by its id
    and the hash of its words."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(text).alias("text"))
    seeds = rows.mapInArrow(_seeds, "h long, twice boolean").groupBy("h").agg(F.count("*").alias("n"), F.max("twice").alias("t"))
    seen = spark.sparkContext.broadcast(bitmap(seeds.where("n > 1 or t"), "h", bits))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((DEPTH, BINS), np.int64)
        for b in _chunks(batches):
            r, _ = _split(_suffixes(b, seen.value, bits))
            for k in range(DEPTH):
                total[k] += np.bincount((_prefix(r, k + 1) % np.uint64(BINS)).astype(np.int64), minlength=BINS)
        k, v = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k * BINS + v, pa.int64()), pa.array(total[k, v])], names=["bin", "n"])

    # how many suffixes begin with each prefix (hashed to 2**14 bins a length: a table of fixed size)
    sizes = np.zeros(DEPTH * BINS, np.int64)
    for r in rows.mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        sizes[r[0]] = r[1]
    sizes = sizes.reshape(DEPTH, BINS)
    many = int(max(partitions(spark), -(-int(sizes[0].sum()) // group)))
    most = max(1, int(sizes[0].sum()) // (4 * many))  # a prefix of more is split by one more symbol
    heavy = spark.sparkContext.broadcast(sizes > most)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            r, again = _split(_suffixes(b, seen.value, bits))
            if len(again):
                yield _place(again, many)
            if len(r):
                to, open_ = np.zeros(len(r), np.uint64), np.ones(len(r), bool)
                for k in range(DEPTH):
                    h = _prefix(r, k + 1)
                    to[open_] = h[open_]
                    open_ &= heavy.value[k][(h % np.uint64(BINS)).astype(np.int64)]
                yield _pack((W.mix(to) % np.uint64(many)).astype(np.int64), r, 0)

    dealt = rows.mapInArrow(deal, "g long, kind int, r binary").repartition(many, "g").sortWithinPartitions("g", "kind")
    places = dealt.mapInArrow(_trees(many), "g long, r binary").repartition(many, "g").sortWithinPartitions("g")
    return cut(places.mapInArrow(_gather, "id long, h long, starts binary"), "repeats")


def _covered(starts: list[bytes], n: int) -> np.ndarray:
    """The words under windows that start at any of the places."""
    edge = np.zeros(n + WINDOW + 1, np.int64)
    at = np.unique(np.frombuffer(b"".join(starts), np.uint32)).astype(np.int64)
    edge[at] += 1
    edge[at + WINDOW] -= 1
    return np.cumsum(edge)[:n] > 0


def _joined(w: W.Words, i: int, gone: np.ndarray | None = None) -> bytes:
    """The kept words of text i joined by one space."""
    a, z = w.bounds[i], w.bounds[i + 1]
    s, e = w.start[a:z], w.end[a:z]
    if gone is not None:
        s, e = s[~gone], e[~gone]
    if not len(s):
        return b""
    lo, hi = s[0], e[-1]
    edge = np.zeros(hi - lo + 1, np.int8)
    edge[s - lo] += 1
    edge[e - lo] -= 1
    keep = np.cumsum(edge[:-1], dtype=np.int8) > 0
    out = w.data[lo:hi].copy()
    out[e[:-1] - lo] = 32  # the separator after each word but the last
    keep[e[:-1] - lo] = True
    return out[keep].tobytes()


def _cut_out(w: W.Words, i: int, gone: np.ndarray) -> bytes:
    """Text i without the removed words and the separators after them; the rest is as it was."""
    a, z = w.offsets[i], w.offsets[i + 1]
    s = w.start[w.bounds[i]:w.bounds[i + 1]]
    edge = np.zeros(z - a + 1, np.int64)
    np.add.at(edge, s[gone] - a, 1)
    np.add.at(edge, np.append(s[1:], z)[gone] - a, -1)
    return w.data[a:z][np.cumsum(edge[:-1]) == 0].tobytes()


def _digest(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ids, n, h, sha = b.column(0).to_numpy(), [], [], []
    for a, z, data, at in W.slices(b.column(1)):
        w = W.words(data, at)
        n.append(np.diff(w.bounds))
        h.append(_text_hash(w).astype(np.int64))
        sha.extend(hashlib.sha256(_joined(w, i)).hexdigest() for i in range(z - a))
    if len(ids):
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(h)), pa.array(np.concatenate(n), pa.int64()), pa.array(sha)], names=["id", "h", "n_words", "sha"])


def substring_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", bits: int = 26, digest: bool = False) -> DataFrame:
    """Removes every word under a window of 20 words that also starts earlier.

    Earlier means a smaller id, or the same id and an earlier place; windows
    are judged on the input. Returns the rows of ``docs`` with the words taken
    out of ``text`` (separators of what stays are kept), all other columns as
    they were; with ``digest``, ``doc_id, n_words, n_removed, kept_sha256``
    (kept words joined by one space). Null and empty texts have no words and
    come back as they are. A null id orders first. Rows with the same id count
    as one document: equal rows take nothing from each other. Columns of any
    name pass through. An empty table gives an empty result. ``bits`` sizes two bitmaps
    that are filters only and bound what is broadcast.
    """
    spark = docs.sparkSession
    found = repeated_windows(docs, id, text, bits)
    hit = spark.sparkContext.broadcast(bitmap(found.select(F.xxhash64("id").alias("k")), "k", bits - 2))
    key = F.coalesce(F.col(id).cast("long"), F.lit(NULL_ID))
    schema = docs.schema
    whole = docs.select(key.alias("id"), F.col(text).alias("text"), F.xxhash64(key).alias("k"), *([] if digest else [F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("row")]))

    def touched(b: pa.RecordBatch, yes: bool) -> pa.RecordBatch:
        """The batch's rows that may have repeats, or the others; without the hash."""
        inside = in_bitmap(hit.value, bits - 2, b.column(2).to_numpy().view(np.uint64))
        b = b.filter(pa.array(inside == yes))
        return pa.RecordBatch.from_arrays([c for k, c in enumerate(b.columns) if k != 2], names=[x for k, x in enumerate(b.schema.names) if k != 2])

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            b = touched(b, False)
            yield from _digest(b) if digest else [b.select(["row"])]

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            b = touched(b, True)
            h = [_text_hash(W.words(data, at)).astype(np.int64) for _, _, data, at in W.slices(b.column(1))]
            if h:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(h))], names=[*b.schema.names, "h"])

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A text's places come first in its group, then its rows."""
        starts: list[bytes] = []
        last = None
        for b in batches:
            out_n, out_gone, out_text, rows = [], [], [], []
            ids, h = b.column(0).to_numpy(), b.column(1).to_numpy()
            texts, places = b.column(2), b.column(3)
            for k in range(b.num_rows):
                if (ids[k], h[k]) != last:
                    last, starts = (ids[k], h[k]), []
                if places[k].is_valid:
                    starts.append(places[k].as_py())
                    continue
                data, at = W.utf8(texts.slice(k, 1))
                w = W.words(data, at)
                n = len(w.hash)
                gone = _covered(starts, n) if starts else np.zeros(n, bool)
                rows.append(k)
                out_n.append(n)
                out_gone.append(int(gone.sum()))
                if digest:
                    out_text.append(hashlib.sha256(_joined(w, 0, gone)).hexdigest())
                else:
                    out_text.append(_cut_out(w, 0, gone).decode() if texts[k].is_valid else None)
            if rows:
                cols = [pa.array(ids[rows]), pa.array(out_n, pa.int64()), pa.array(out_gone, pa.int64()), pa.array(out_text, pa.string())]
                names = ["id", "n_words", "n_removed", "out"]
                if not digest:
                    cols.append(b.column(4).take(pa.array(rows)))
                    names.append("row")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    def shape(ddl: str, *after: str) -> T.StructType:
        """Fields, the whole row among them unless digests are asked for."""
        out = T.StructType.fromDDL(ddl) if ddl else T.StructType()
        out = out if digest else out.add("row", schema)
        for name in after:
            out = out.add(name, T.LongType())
        return out

    extra = [] if digest else ["row"]
    affected = whole.mapInArrow(hashes, shape("id long, text string", "h"))
    empty_row = [] if digest else [F.lit(None).cast(schema).alias("row")]
    both = (affected.select("id", "h", "text", F.lit(None).cast("binary").alias("starts"), *extra, F.lit(1).alias("o"))
            .unionByName(found.select("id", "h", F.lit(None).cast("string").alias("text"), "starts", *empty_row, F.lit(0).alias("o"))))
    edited = (both.repartition("id", "h").sortWithinPartitions("id", "h", "o").select("id", "h", "text", "starts", *extra)
              .mapInArrow(edit, shape("id long, n_words long, n_removed long, out string")))
    real = F.when(F.col("id") != NULL_ID, F.col("id")).alias(id)
    if digest:
        same = (whole.mapInArrow(plain, "id long, h long, n_words long, sha string")
                .select("id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("out")))
        return edited.unionByName(same).select(real, "n_words", "n_removed", F.col("out").alias("kept_sha256"))
    same = whole.mapInArrow(plain, shape(""))
    changed = edited.select(F.col("row").withField(_quoted(text), F.col("out")).alias("row"))
    return changed.unionByName(same).select("row.*")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
