"""Repair of conversation structure by a run-length dynamic program.

A conversation is a word of symbols, role and fault of each row. The cheapest
edits that turn its roles into ``(s?(ua)+)?`` are a shortest path through four
states: nothing, s, u, a. Equal consecutive symbols are one run; a run's
min-plus transition is a product of cached binary powers, and the choices
within a run are unrolled by halves, from those powers again.

Rows are sorted by ranges of (conversation, turn, digest) without their texts and cut into
segments of at most ``SEGMENT`` rows, so that one long conversation lies in many. A segment's
transition is a 4 x 4 matrix; per conversation only these matrices meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

# Fixed values of the rules: costs, and the edits by their initials.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SEGMENT = 512
FAR = 1 << 60
NOTHING, S, U, A = range(4)
INITIALS = "sua"  # role 0, 1, 2; 3: any other
OK, CUT_OFF, GONE = range(3)  # fault of a symbol; symbol = role * 3 + fault
NEXT = {NOTHING: U, S: U, U: A, A: U}  # where an inserted or reroled row leads
ROLE = {U: "user", A: "assistant"}

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def _keeps(state: int, symbol: int) -> int | None:
    """The state after a row kept as it is; None if its role doesn't fit here."""
    role = symbol // 3
    if role == 0:
        return S if state == NOTHING else None
    return role + 1 if role < 3 and NEXT[state] == role + 1 else None


def times(m: Matrix, n: Matrix) -> Matrix:
    """Min-plus product."""
    return tuple(tuple(min(FAR, *(a + b for a, b in zip(row, col, strict=True))) for col in zip(*n, strict=True)) for row in m)


def apply(m: Matrix, h: Vector) -> Vector:
    return tuple(min(FAR, *(a + b for a, b in zip(row, h, strict=True))) for row in m)


UNIT: Matrix = tuple(tuple(0 if p == q else FAR for q in range(4)) for p in range(4))


def _closure() -> Matrix:
    """Cheapest insertions from state to state."""
    one = tuple(tuple(0 if p == q else INSERT if NEXT[p] == q else FAR for q in range(4)) for p in range(4))
    return times(times(one, one), one)


INSERTS = _closure()
END: Vector = apply(INSERTS, (0, FAR, FAR, 0))  # cost to go after the last row: only nothing and a may end


@lru_cache(maxsize=None)  # 12 symbols
def transition(symbol: int) -> Matrix:
    """One row: insertions, then keep, rerole or delete."""
    fault = symbol % 3
    edit = [[FAR] * 4 for _ in range(4)]
    for q in range(4):
        edit[q][q] = DELETE
        if fault != GONE:
            extra = TRUNCATED if fault == CUT_OFF else 0
            edit[q][NEXT[q]] = min(edit[q][NEXT[q]], REROLE + extra)
            if (t := _keeps(q, symbol)) is not None:
                edit[q][t] = min(edit[q][t], extra)
    return times(INSERTS, tuple(map(tuple, edit)))


@lru_cache(maxsize=None)  # 12 symbols, 63 powers at most
def power(symbol: int, k: int) -> Matrix:
    """Transition of 2**k equal rows."""
    if k == 0:
        return transition(symbol)
    half = power(symbol, k - 1)
    return times(half, half)


def advance(symbol: int, n: int, h: Vector) -> Vector:
    """Cost to go before ``n`` equal rows, from that after them."""
    for k in range(n.bit_length()):
        if n >> k & 1:
            h = apply(power(symbol, k), h)
    return h


def of_runs(runs: list[tuple[int, int]]) -> Matrix:
    """Transition of a segment: the images of the unit vectors, run by run from its end."""
    columns = []
    for t in range(4):
        h: Vector = tuple(0 if q == t else FAR for q in range(4))
        for symbol, n in reversed(runs):
            h = advance(symbol, n, h)
        columns.append(h)
    return tuple(zip(*columns, strict=True))


@lru_cache(maxsize=1 << 14)
def unroll(symbol: int, n: int, h: Vector, q: int) -> tuple[str, int]:
    """Edits of ``n`` equal rows from state ``q`` with cost to go ``h`` (least component 0) after them, and the state then.

    Of equally cheap edits the ASCII-least; no audit is the beginning of
    another of one cost, so the least letter at each place gives the least audit.
    """
    if n > 1:
        left, p = unroll(symbol, n // 2, _level(advance(symbol, n - n // 2, h)), q)
        right, p = unroll(symbol, n - n // 2, h, p)
        return left + right, p
    here, letters = apply(transition(symbol), h), ""
    extra = TRUNCATED if symbol % 3 == CUT_OFF else 0
    while True:
        if here[q] == DELETE + h[q]:
            return letters + "D", q
        if here[q] == INSERT + here[NEXT[q]]:
            letters, q = letters + "I", NEXT[q]
            continue
        if symbol % 3 != GONE and (t := _keeps(q, symbol)) is not None and here[q] == extra + h[t]:
            return letters + "K", t
        return letters + "R", NEXT[q]


def _level(h: Vector) -> Vector:
    low = min(h)
    return tuple(x - low for x in h)


def closing(q: int) -> str:
    """Insertions after the last row."""
    letters = ""
    while q not in (NOTHING, A):
        letters, q = letters + "I", NEXT[q]
    return letters


def runs_of(symbols: Iterable[int]) -> list[tuple[int, int]]:
    return [(x, sum(1 for _ in g)) for x, g in groupby(symbols)]


def choices(runs: list[tuple[int, int]], h: Vector, q: int) -> tuple[str, int]:
    """A segment's edits from state ``q``, with cost to go ``h`` after it, and the state after it."""
    after = []
    for symbol, n in reversed(runs):
        after.append(h)
        h = advance(symbol, n, h)
    letters = []
    for (symbol, n), g in zip(runs, reversed(after), strict=True):
        s, q = unroll(symbol, n, _level(g), q)
        letters.append(s)
    return "".join(letters), q


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, n``: rows with ``n`` copies each, damaged by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row (n is 0), 1 empties its text, 2 takes out its ``[.!?]``, 3 repeats it, 4 makes it the user's. Null ids, turns, roles and texts count as one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    way = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = space("text")
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(way == 4, "user").otherwise(space("role")).alias("role"),
                       F.when(way == 1, "").when(way == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                       F.when(way == 0, 0).when(way == 3, 2).otherwise(1).alias("n"))


def _key() -> Column:
    return F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))


class Repair:
    """Cheapest repairs of ``conv_id, turn, role, text, n`` rows (``n`` copies, 0: a conversation without this row).

    A conversation's rows go by turn, nulls first; rows of one turn by the
    SHA-256 of role and text; equal rows are neighbours. Null roles and texts
    count as one space. Null conversation ids are one conversation. An
    empty table gives empty results; other columns are not read. A role that
    begins with none of s, u, a can only be reroled or deleted.
    """

    def __init__(self, rows: DataFrame, segment: int = SEGMENT):
        none = lambda c: F.coalesce(c, F.lit(" "))
        self.rows = rows.select("conv_id", "turn", none("role").alias("role"), none("text").alias("text"), "n").withColumn("key", _key())
        last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
        role = F.when(F.startswith("role", F.lit("s")), 0).when(F.startswith("role", F.lit("u")), 1).when(F.startswith("role", F.lit("a")), 2).otherwise(3)
        fault = F.when(last == "", GONE).when(~last.isin(".", "!", "?"), CUT_OFF).otherwise(OK)
        one = (self.rows.select("conv_id", "turn", "key", (role * 3 + fault).cast("int").alias("symbol"), F.col("n").cast("long").alias("n"))
               .groupBy("conv_id", "turn", "key", "symbol").agg(F.sum("n").alias("n")))
        # role and text seen in an earlier turn; only those of several turns are joined, and Spark may split a hot one
        seen = (one.where("n > 0").groupBy("conv_id", "key").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns")).where("turns > 1")
                .select(F.col("conv_id").alias("c"), F.col("key").alias("k"), F.col("first.turn").alias("first"), F.lit(True).alias("several")))
        marked = (one.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left")
                  .select("conv_id", "turn", "key", "symbol", "n", (F.coalesce("several", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first"))).alias("later")))
        order = [F.col("conv_id"), F.col("n") > 0, F.col("turn"), F.col("key")]  # dropped rows first: a conversation ends with a live one, if it has any
        sorted_rows = marked.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
        self.segments = cut(sorted_rows.mapInArrow(_segments(segment), "conv_id long, segment long, turns array<long>, keys array<binary>, symbols array<int>, copies array<long>, "
                                                   "later array<boolean>, way array<long>, ends array<int>, illegal long, distinct_turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long"), "segments")
        self._met = self._chosen = None

    def _paths(self) -> DataFrame:
        """``conv_id, segment, after, cost, illegal, gaps, last``: the cost to go after each segment, and its conversation's totals."""
        if self._met is None:
            s = F.sort_array(F.collect_list(F.struct("segment", "way", "ends", "illegal", "first_turn", "last_turn", "distinct_turns")))
            self._met = cut(self.segments.groupBy("conv_id").agg(s.alias("s"))
                            .mapInArrow(_meet, "conv_id long, segment long, after array<long>, cost long, illegal long, gaps long, last boolean"), "paths")
        return self._met

    def _entered(self) -> DataFrame:
        """Segments with the state each is entered in: what the segments before it lead to."""
        if self._chosen is None:
            own = self.segments.select("segment", "symbols", "copies", "later").join(self._paths().select("conv_id", "segment", "after", "last"), "segment")
            led = own.mapInArrow(_leads, "conv_id long, segment long, after array<long>, last boolean, leads array<int>")
            s = F.sort_array(F.collect_list(F.struct("segment", "after", "last", "leads")))
            self._chosen = cut(led.groupBy("conv_id").agg(s.alias("s")).mapInArrow(_enter, "segment long, after array<long>, last boolean, state int"), "entered")
        return self._chosen

    def summary(self) -> DataFrame:
        """``conv_id, gaps, blank, duplicate, truncated, illegal, cost`` of every conversation, those without rows too."""
        faults = self.segments.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
        total = self._paths().where("last").select(F.col("conv_id").alias("c"), "gaps", "illegal", "cost")
        return faults.join(total, F.col("conv_id").eqNullSafe(F.col("c"))).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def decisions(self) -> DataFrame:
        """``conv_id, turn, key, at, letters, state``: the edits at each row (of its copies together), ``state`` the state before them.
        Insertions stand before the row that they precede, closing ones behind the last."""
        own = self.segments.select("conv_id", "segment", "turns", "keys", "symbols", "copies", "later").join(self._entered(), "segment")
        return own.mapInArrow(_decide, "conv_id long, turn long, key binary, at long, letters string, state int")

    def _merged(self, *by: str) -> DataFrame:
        d = self.decisions().select("conv_id", "turn", "key", F.lit(0).alias("kind"), "at", "letters", "state", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
        t = self.rows.where("n > 0").select("conv_id", "turn", "key", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("at"), F.lit(None).cast("string").alias("letters"),
                                            F.lit(None).cast("int").alias("state"), "role", "text")
        return d.unionByName(t).repartition(*by).sortWithinPartitions("conv_id", "turn", "key", "kind")

    def repaired(self) -> DataFrame:
        """``conv_id, place, role, text``: the rows of the repaired conversations, ordered by ``place`` within each. Dealt by row, so a long conversation spreads."""
        return self._merged("conv_id", "turn", "key").mapInArrow(_rows, "conv_id long, place long, role string, text string")

    def digests(self) -> DataFrame:
        """``conv_id, audit, repaired_sha256``. A conversation is hashed in order as it streams by; only its audit is held, one letter an edit."""
        return self._merged("conv_id").mapInArrow(_hashes, "conv_id long, audit string, repaired_sha256 string")


def repair_digest(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of ``conv_id, turn, role, text, n`` rows."""
    r = Repair(rows)
    d = r.digests().withColumnRenamed("conv_id", "c")
    return (r.summary().join(d, F.col("conv_id").eqNullSafe(F.col("c")), "left")
            .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))


def _dicts(batches: Iterator[pa.RecordBatch], most: int = 1024) -> Iterator[dict]:
    for b in batches:
        for k in range(0, b.num_rows, most):
            yield from b.slice(k, most).to_pylist()


def _batches(rows: Iterable[tuple], schema: pa.Schema, most: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) == most:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


LONG, INT = pa.int64(), pa.int32()


def _schema(**fields: pa.DataType) -> pa.Schema:
    return pa.schema(list(fields.items()))


def _expand(symbols: list[int], copies: list[int], later: list[bool]) -> Iterator[tuple[int, int]]:
    """Runs of a segment's rows: a first copy, unless it was seen before, then the duplicates."""
    for x, n, old in zip(symbols, copies, later, strict=True):
        gone = x - x % 3 + GONE
        if n:
            yield (gone if old else x), 1
        if n > 1:
            yield gone, n - 1


def _runs(symbols: list[int], copies: list[int], later: list[bool]) -> list[tuple[int, int]]:
    """As runs for the dynamic program: deleted rows are one symbol, whatever their role."""
    plain = [(GONE if x % 3 == GONE else x, n) for x, n in _expand(symbols, copies, later)]
    return [(x, sum(n for _, n in g)) for x, g in groupby(plain, key=lambda r: r[0])]


def _segments(most: int):
    """Rows sorted by conversation as segments with their transition and counts."""
    schema = _schema(conv_id=LONG, segment=LONG, turns=pa.list_(LONG), keys=pa.list_(pa.binary()), symbols=pa.list_(INT), copies=pa.list_(LONG), later=pa.list_(pa.bool_()), way=pa.list_(LONG),
                     ends=pa.list_(INT), illegal=LONG, distinct_turns=LONG, first_turn=LONG, last_turn=LONG, blank=LONG, duplicate=LONG, truncated=LONG)

    def close(conv, rows: list[dict]) -> tuple:
        live = [r for r in rows if r["n"]]
        symbols, copies, later = [r["symbol"] for r in live], [r["n"] for r in live], [r["later"] for r in live]
        roles = [(x // 3, n) for x, n in _expand(symbols, copies, later)]
        illegal = sum(n - 1 for _, n in roles) + sum((a, b) not in LEGAL for (a, _), (b, _) in zip(roles, roles[1:], strict=False))
        turns = [r["turn"] for r in live if r["turn"] is not None]
        blank = sum(n for x, n in zip(symbols, copies, strict=True) if x % 3 == GONE)
        duplicate = sum(n - (not old) for x, n, old in zip(symbols, copies, later, strict=True) if x % 3 != GONE)
        truncated = sum(x % 3 == CUT_OFF and not old for x, old in zip(symbols, later, strict=True))
        way = of_runs(_runs(symbols, copies, later))
        return (conv, rows[0]["at"], [r["turn"] for r in live], [r["key"] for r in live], symbols, copies, later, [c for row in way for c in row], [roles[0][0], roles[-1][0]] if roles else [], illegal,
                len(set(turns)), turns[0] if turns else None, turns[-1] if turns else None, blank, duplicate, truncated)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: list[dict] = []
        for r in _dicts(batches):
            if held and (r["conv_id"] != held[0]["conv_id"] or len(held) == most):
                yield close(held[0]["conv_id"], held)
                held = []
            held.append(r)
        if held:
            yield close(held[0]["conv_id"], held)

    return lambda batches: _batches(rows_of(batches), schema, 64)


LEGAL = {(0, 1), (1, 2), (2, 1)}  # su, ua, au


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost to go after each segment of a conversation, from its last to its first; its cost, illegal neighbours and gaps."""
    def rows() -> Iterator[tuple]:
        for r in _dicts(batches, 64):
            h, after = END, []
            for s in reversed(r["s"]):
                after.append(h)
                h = apply(tuple(tuple(s["way"][q * 4:q * 4 + 4]) for q in range(4)), h)
            illegal, distinct, before, turn, low = 0, 0, None, None, None
            for s in r["s"]:
                illegal += s["illegal"]
                if s["ends"]:
                    illegal += before is not None and (before, s["ends"][0]) not in LEGAL
                    before = s["ends"][1]
                if s["first_turn"] is not None:
                    distinct += s["distinct_turns"] - (s["first_turn"] == turn)
                    low, turn = s["first_turn"] if low is None else low, s["last_turn"]
            gaps = 0 if low is None else turn - low + 1 - distinct
            for s, g in zip(r["s"], reversed(after), strict=True):
                yield r["conv_id"], s["segment"], list(g), h[NOTHING], illegal, gaps, s is r["s"][-1]
    return _batches(rows(), _schema(conv_id=LONG, segment=LONG, after=pa.list_(LONG), cost=LONG, illegal=LONG, gaps=LONG, last=pa.bool_()))


def _leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each state that a segment may be entered in, the state it leads to."""
    def rows() -> Iterator[tuple]:
        for r in _dicts(batches, 64):
            runs = _runs(r["symbols"], r["copies"], r["later"])
            yield r["conv_id"], r["segment"], r["after"], r["last"], [choices(runs, tuple(r["after"]), q)[1] for q in range(4)]
    return _batches(rows(), _schema(conv_id=LONG, segment=LONG, after=pa.list_(LONG), last=pa.bool_(), leads=pa.list_(INT)))


def _enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for r in _dicts(batches, 64):
            q = NOTHING
            for s in r["s"]:
                yield s["segment"], s["after"], s["last"], q
                q = s["leads"][q]
    return _batches(rows(), _schema(segment=LONG, after=pa.list_(LONG), last=pa.bool_(), state=INT))


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for r in _dicts(batches, 64):
            letters, end = choices(_runs(r["symbols"], r["copies"], r["later"]), tuple(r["after"]), r["state"])
            p, q = 0, r["state"]
            for k, (turn, key, symbol, n) in enumerate(zip(r["turns"], r["keys"], r["symbols"], r["copies"], strict=True)):
                a, state = p, q
                while n:  # a copy's letters: insertions, then its own
                    q, own = step(q, letters[p], symbol)
                    n, p = n - own, p + 1
                tail = closing(end) if r["last"] and k == len(r["turns"]) - 1 else ""
                yield r["conv_id"], turn, key, r["segment"] + k, letters[a:p] + tail, state
    return _batches(rows(), _schema(conv_id=LONG, turn=LONG, key=pa.binary(), at=LONG, letters=pa.string(), state=INT))


def step(q: int, letter: str, symbol: int) -> tuple[int, int]:
    """State after an edit, and how many rows it uses."""
    if letter == "D":
        return q, 1
    if letter == "K":
        t = _keeps(q, symbol)
        return q if t is None else t, 1
    return NEXT[q], int(letter == "R")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, list[tuple[str, str]], int]]:
    """``conv_id, letters, [(role, text), ...], at`` of each row, from a decision and the row's text that follows it in the sort."""
    decision = None
    for r in _dicts(batches):
        if r["kind"] == 0:
            decision = r
            continue
        if decision is None:  # a further copy of a row already done
            continue
        out, q = [], decision["state"]
        for letter in decision["letters"]:
            if letter == "K":
                out.append((r["role"], r["text"]))
                q = {"s": S, "u": U}.get(r["role"][0], A)
            elif letter != "D":
                q = NEXT[q]
                out.append((ROLE[q], r["text"] if letter == "R" else ""))
        yield decision["conv_id"], decision["letters"], out, decision["at"]
        decision = None


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((conv, at * 8 + k, role, text) for conv, _, out, at in _edited(batches) for k, (role, text) in enumerate(out))
    return _batches(rows, _schema(conv_id=LONG, place=LONG, role=pa.string(), text=pa.string()), 512)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for conv, edits in groupby(_edited(batches), key=lambda e: e[0]):
            h, audit, first = hashlib.sha256(), [], True
            for _, letters, out, _ in edits:
                audit.append(letters)
                for role, text in out:
                    h.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            yield conv, "".join(audit), h.hexdigest()
    return _batches(rows(), _schema(conv_id=LONG, audit=pa.string(), repaired_sha256=pa.string()), 64)


REPAIR_SQL = r"""
WITH RECURSIVE t AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_concat([i], range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) AS r(i))),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, t, concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS s FROM conversations, t),
w AS (SELECT *, xor(list_reduce(list_concat([4294967295], [CAST(ord(x) AS BIGINT) for x in string_split(s, '')]),
  lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 20 AS way FROM k),
d AS (SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role, CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE way WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM w),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(concat(length(role), ':', role, text)), copy) AS rn,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS tail FROM d),
f AS MATERIALIZED (SELECT conv_id, turn, rn, role, text, left(role, 1) AS c, CASE WHEN tail = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'ok' END AS fault FROM o),
g AS (SELECT *, concat(lag(c) OVER (PARTITION BY conv_id ORDER BY rn), c) AS two FROM f),
n AS (SELECT c.conv_id, count(g.rn) AS rows, CAST(coalesce(max(g.turn) - min(g.turn) + 1 - count(DISTINCT g.turn), 0) AS BIGINT) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (rn > 1 AND two NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON c.conv_id IS NOT DISTINCT FROM g.conv_id GROUP BY c.conv_id),
e AS MATERIALIZED (SELECT c, fault, p, i.k * 5 + x.cost + CASE WHEN x.letter <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS cost, repeat('I', i.k) || x.letter AS letters, x.q
  FROM (SELECT DISTINCT c, fault FROM f) s,
  (VALUES (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 2), (2, 1, 3), (2, 2, 2), (3, 0, 3), (3, 1, 2), (3, 2, 3)) i(p, k, m),
  (VALUES (0, 'D', 2, 0, ''), (1, 'D', 2, 1, ''), (2, 'D', 2, 2, ''), (3, 'D', 2, 3, ''), (0, 'R', 1, 2, ''), (1, 'R', 1, 2, ''), (2, 'R', 1, 3, ''), (3, 'R', 1, 2, ''),
          (0, 'K', 0, 1, 's'), (0, 'K', 0, 2, 'u'), (1, 'K', 0, 2, 'u'), (2, 'K', 0, 3, 'a'), (3, 'K', 0, 2, 'u')) x(m, letter, cost, q, role)
  WHERE i.m = x.m AND (x.letter <> 'K' OR x.role = s.c) AND (x.letter = 'D' OR s.fault IN ('ok', 'truncated'))),
p AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, struct_pack(cost := CAST(0 AS BIGINT), audit := '') AS best FROM n
  UNION ALL
  SELECT p.conv_id, p.i + 1, e.q, min(struct_pack(cost := CAST(p.best.cost + e.cost AS BIGINT), audit := p.best.audit || e.letters))
  FROM p JOIN f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.rn = p.i + 1 JOIN e ON e.c = f.c AND e.fault = f.fault AND e.p = p.q GROUP BY p.conv_id, p.i, e.q),
b AS (SELECT n.conv_id, min(struct_pack(cost := p.best.cost + CASE p.q WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END, audit := p.best.audit || CASE p.q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END)) AS best
  FROM n JOIN p ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = n.rows GROUP BY n.conv_id),
l AS (SELECT conv_id, generate_subscripts(string_split(best.audit, ''), 1) AS pos, unnest(string_split(best.audit, '')) AS letter FROM b WHERE best.audit <> ''),
m AS (SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY pos) AS rn, count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY pos) AS j FROM l),
r AS (SELECT m.*, f.role, f.text, max(CASE WHEN j = 1 AND letter = 'K' AND f.c = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY m.conv_id) AS s
  FROM m LEFT JOIN f ON m.conv_id IS NOT DISTINCT FROM f.conv_id AND m.rn = f.rn AND m.letter <> 'I'),
h AS (SELECT conv_id, sha256(string_agg(concat(CASE WHEN letter = 'K' THEN role WHEN (j - s) % 2 = 1 THEN 'user' ELSE 'assistant' END, ':', coalesce(text, '')), chr(10) ORDER BY pos)) AS hash
  FROM r WHERE letter <> 'D' GROUP BY conv_id)
SELECT n.conv_id, gaps, blank, duplicate, truncated, illegal, b.best.cost AS cost, b.best.audit AS audit, coalesce(h.hash, sha256('')) AS repaired_sha256
FROM n JOIN b ON n.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN h ON n.conv_id IS NOT DISTINCT FROM h.conv_id
"""
