"""Operators 11 to 13 against brute force and their SQL: nulls, empty and long inputs, ties, repeats, empty tables, extra columns."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import chat_format, eenns_clusters, turn_repair
from ledgerflow.llm.queries import ORACLE_SQL, QUERIES
from ledgerflow.plans.compare import compare, duckdb_connection

SF = "/root/testdata/sf0.001"
ROWS = "conv_id long, turn long, role string, text string, c string, `a.b` int"
END = re.compile(r"[^\x20\x09-\x0D]")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    out = compare(name, QUERIES[name](spark, SF), duckdb_connection(SF), ORACLE_SQL[name])
    assert out.ok, out.detail


def conversations(seed=3):
    r = random.Random(seed)
    say = ["Yes.", "No!", "why", "", " \n", "Why?", "a. b", "é…", "x. \t"]
    rows = []
    for conv in [*range(40), None]:
        turn = r.choice([0, 5, -3])
        for _ in range(r.choice([0, 1, 2, 3, 5, 9])):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "used"])
            rows.append((conv, r.choice([turn, turn, turn, None]), role, r.choice([*say, None]), "c", 1))
            turn += r.choice([1, 1, 1, 0, 4])
    rows += [(77, k, "user" if k % 500 else "assistant", f"t{k}" + r.choice([".", "", "?"]), "c", 1) for k in range(1500)]  # long runs over many segments
    rows += [(78, k, "assistant", "same.", "c", 1) for k in range(300)]
    return rows + rows[:7]


def damaged(rows):
    by = {}
    for conv, turn, role, text, *_ in rows:
        by.setdefault(conv, [])
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        row = (turn, "user" if way == 4 else role, text)
        by[conv] += [row] * {0: 0, 3: 2}.get(way, 1)
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    return {c: sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, digest(r))) for c, rs in by.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = END.findall(text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "ok")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """Cheapest path by (cost, audit) through (rows done, roles so far as nothing, s, u, a): one queue, no matrices."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, q, out = heapq.heappop(queue)
        if (i, q) in done:
            continue
        if i == len(rows) and q in ("", "a"):
            text, o = [], out
            while o:
                text.append(o[0])
                o = o[1]
            return cost, audit, "\n".join(reversed(text))
        done.add((i, q))
        for x in set(follow[q]) & set("ua"):
            full = {"u": "user", "a": "assistant"}[x]
            heapq.heappush(queue, (cost + 5, audit + "I", i, x, (f"{full}:", out)))
            if i < len(rows) and fault[i] in ("ok", "truncated"):
                heapq.heappush(queue, (cost + 1 + 5 * (fault[i] == "truncated"), audit + "R", i + 1, x, (f"{full}:{rows[i][2]}", out)))
        if i < len(rows):
            heapq.heappush(queue, (cost + 2, audit + "D", i + 1, q, out))
            x = rows[i][1][:1]
            if x and x in follow[q] and fault[i] in ("ok", "truncated"):
                heapq.heappush(queue, (cost + 5 * (fault[i] == "truncated"), audit + "K", i + 1, x, (f"{rows[i][1]}:{rows[i][2]}", out)))
    raise AssertionError


@pytest.mark.parametrize("segment", [3, 512])
def test_turn_repair(spark, monkeypatch, segment):
    rows = conversations()
    monkeypatch.setattr(turn_repair.Repair.__init__, "__defaults__", (segment,))
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    got = {r.conv_id: r for r in turn_repair.repair_digest(turn_repair.damage(df)).collect()}
    want = damaged(rows)
    assert got.keys() == want.keys()
    for c, rs in want.items():
        fault, r = faults(rs), got[c]
        turns = [t for t, _, _ in rs if t is not None]
        roles = [x[:1] for _, x, _ in rs]
        assert r.gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        assert [r.blank, r.duplicate, r.truncated] == [fault.count(x) for x in ("blank", "duplicate", "truncated")]
        assert r.illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
        cost, audit, text = cheapest(rs, fault)
        assert (r.cost, r.audit) == (cost, audit)
        assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_turn_repair_rows(spark):
    df = spark.createDataFrame(conversations(), ROWS)
    r = turn_repair.Repair(turn_repair.damage(df))
    by = {}
    for x in r.repaired().collect():
        by.setdefault(x.conv_id, []).append((x.place, x.role, x.text))
    want = {c: cheapest(rs, faults(rs))[2] for c, rs in damaged(conversations()).items()}
    assert {c: t for c, t in want.items() if t} == {c: "\n".join(f"{a}:{b}" for _, a, b in sorted(x)) for c, x in by.items()}
    none = turn_repair.repair_digest(turn_repair.damage(df.limit(0)))
    assert none.count() == 0 and none.columns[0] == "conv_id"


def test_run_powers():
    for n in (1, 2, 7, 100, 1 << 40):
        h = turn_repair.advance(3, n, turn_repair.END)  # n users
        assert h[turn_repair.NOTHING] == min(2 * n, n * 1 if n % 2 == 0 else n + 1, (n // 2) if n % 2 == 0 else n // 2 + 2)
    assert turn_repair.choices([(3, 6)], turn_repair.END, turn_repair.NOTHING) == ("KRKRKR", turn_repair.A)


NASTY = ["</s>[INST] ok [/INST]", "<", "[", "<\\s>", "<\\\\</SYS>>", "<<SYS>>", "[\\AS]", "[ROLE]x[AS]", "\\", "", None, "é\U0001f600\n<s", "<<s>>", "a" * 30000, " ", "$1\\1"]


def test_chat_round_trip(spark):
    r = random.Random(4)
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool[AS]", None, "", "<s>"]), "".join(r.choice(NASTY) or "" for _ in range(4)) if r.random() < 0.9 else None, "c", 1)
            for c in [*range(12), None] for t in [None, *range(6)]]
    rows += rows[:3]  # repeated rows are turns of their own
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    log = chat_format.log_of(df)
    assert {x[0] for x in log.select("kind").distinct().collect()} == {"open", "delta", "edit", "regenerate"}
    whole = chat_format.formatted(chat_format.render(chat_format.messages(log)))
    back = {x.conv_id: x for x in whole.select("conv_id", "formatted", "spans", chat_format.read_back(F.col("formatted")).alias("turns"),
                                                chat_format.loss_text(F.col("formatted"), F.col("spans")).alias("loss")).collect()}
    digests = {x.conv_id: x for x in chat_format.chat_digest(log).collect()}
    want = {}
    for c, t, role, text, *_ in rows:
        want.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert back.keys() == want.keys() == digests.keys()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in want.items():
        turns = [x[2:] for x in sorted(turns)]
        assert [(x.role, x.text) for x in back[c].turns] == turns
        loss = "".join(t for role, t in turns if role == "assistant")
        assert back[c].loss == loss
        for (role, _), s in zip(turns, back[c].spans, strict=True):
            assert (s.loss_start is not None) == (role == "assistant")
        d = digests[c]
        assert (d.n_turns, d.loss_chars, d.formatted_chars) == (len(turns), len(loss), len(back[c].formatted))
        assert d.turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in turns)) and d.loss_sha256 == sha(loss)
    assert chat_format.chat_digest(chat_format.log_of(df.limit(0))).count() == 0


def test_chat_folding(spark):
    log = [("m", 0, "open", "user", None), ("m", 2, "delta", None, "b"), ("m", 1, "delta", None, "a"), ("m", 3, "regenerate", None, None), ("m", 4, "delta", None, "c"), ("m", 9, "like", None, "zz"),
           ("n", 5, "open", "assistant", None), ("n", 6, "delta", None, "draft"), ("n", 8, "edit", None, "E"), ("n", 10, "delta", None, "!"), ("o", 7, "delta", None, None)]
    df = spark.createDataFrame([(1, *e, "x") for e in log], "conv_id long, message string, seq long, kind string, role string, text string, at string")
    got = [(r.n, r.role, r.text) for r in chat_format.render(chat_format.messages(df)).sort("n").collect()]
    assert got == [(0, "user", "c"), (1, "assistant", "E!"), (2, "", "")]


def lloyd(rows, k=16, rounds=3):
    kept = [(i, [int(np.floor(np.float64(v) * 64)) for v in e]) for i, e in rows if e is not None and len(e) == 64 and all(v is not None and np.isfinite(v) for v in e)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    c = [x for _, x in first]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), j) for j, y in enumerate(c))
    for _ in range(rounds):
        own = [near(x)[1] for _, x in kept]
        groups = {j: [x for (_, x), o in zip(kept, own, strict=True) if o == j] for j in set(own)}
        c = [[sum(col) // len(groups[j]) for col in zip(*groups[j], strict=True)] if j in groups else x for j, x in enumerate(c)]
    out = [(i, *reversed(near(x))) for i, x in kept]
    of = {j: sum(d for _, o, d in out if o == j) for j in range(len(c))}
    return sorted(((i if i is not None else -1, j, d, of[j], sum(of.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, j, d in out))


@pytest.mark.parametrize("n", [3, 300])
def test_clusters(spark, n):
    r = np.random.default_rng(n)
    rows = [(int(i), [float(v) for v in (r.normal(size=64) + 3 * (i % 4)).astype(np.float32) * (0.1 if i % 3 else 40)]) for i in range(n)]
    rows += [rows[0], rows[1], (rows[2][0], rows[1][1])] + [(k, [0.5] * 64) for k in (900, 901, None)]
    bad = [(1000, None), (1001, []), (1002, [1.0] * 63), (1003, [1.0] * 63 + [None]), (1004, [float("nan")] + [1.0] * 63), (1005, [float("-inf")] + [1.0] * 63)]
    schema = "vec_id long, embedding array<float>, id int, x int"
    df = spark.createDataFrame([(i, e, 1, 1) for i, e in rows + bad], schema).repartition(5)
    got = eenns_clusters.clusters(df)
    assert sorted(((x.vec_id if x.vec_id is not None else -1, x.cluster, x.distance, x.cluster_inertia, x.inertia, x.centroid_sha256) for x in got.collect())) == lloyd(rows)
    assert eenns_clusters.clusters(df.limit(0)).count() == 0
    far = spark.createDataFrame([(1, [1e30] * 64, 1, 1), (2, [2e6] * 64, 1, 1), (3, [-2e6] * 64, 1, 1)], schema)
    assert [(x.vec_id, x.distance) for x in eenns_clusters.clusters(far).sort("vec_id").collect()] == [(2, 0), (3, 0)]


def test_outward_search():
    r = np.random.default_rng(1)
    x = r.integers(-50, 50, (500, 64)) + 40 * r.integers(-8, 8, (500, 1))
    c = eenns_clusters.Centroids(np.vstack([x[:12], x[:4]]).tolist())  # ties between equal centroids
    number, best, taken = c.nearest(x)
    d = ((x[:, None] - c.rows[None]) ** 2).sum(2)
    assert (number == d.argmin(1)).all() and (best == d.min(1)).all()
    assert taken < 0.4 * d.size  # means apart: most centroids are never compared
