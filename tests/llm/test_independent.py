"""Scores and fingerprints against versions that share no code with the operators."""

import bisect
import math
import random

import numpy as np
import pytest

from ledgerflow.llm import lz_fingerprint, quality_gam


@pytest.mark.parametrize("rows", [0, 1, 400])
def test_gam_score_is_a_sum_of_table_entries(rows):
    rng = np.random.default_rng(3)
    width = len(quality_gam.FEATURES)
    x = np.round(rng.normal(size=(rows, width)), 1)       # ties on the edges of bins
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float) if rows else np.zeros(0)
    model = quality_gam.fit(x, y, rounds=8, pairs=3, pair_rounds=4)
    assert bool(model.pairs) == (rows > 1)
    new = np.vstack([np.round(rng.normal(size=(60, width)), 1), np.full((1, width), 1e9), np.full((1, width), -1e9)])
    for row, got in zip(new.tolist(), model.score(new).tolist(), strict=True):
        total = model.base
        for value, edges, table in zip(row, model.edges, model.tables, strict=True):
            total += table[bisect.bisect_right(edges.tolist(), value)]
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            total += table[bisect.bisect_right(model.coarse[i].tolist(), row[i])][bisect.bisect_right(model.coarse[j].tolist(), row[j])]
        assert got == pytest.approx(1 / (1 + math.exp(-max(-40.0, min(40.0, total)))), abs=1e-12)


def test_gam_pairs_tell_what_no_feature_tells():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, len(quality_gam.FEATURES)))
    y = ((x[:, 2] > 0) ^ (x[:, 4] > 0)).astype(float)
    model = quality_gam.fit(x, y)
    assert (4, 2) in model.pairs
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.9


def _parse(text: str) -> list[str]:
    """Phrases of an incremental dictionary of strings."""
    known, out, at = set(), [], 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at:end] in known:
            end += 1
        known.add(text[at:end])
        out.append(text[at:end])
        at = end
    return out


@pytest.mark.parametrize("text", ["", "a", "aaaaaaa", "abracadabra abracadabra", "naïve \U0001f600\U0001f600 \U0001f600", "x" * 5000])
def test_phrases_of_a_plain_parse(text):
    points = np.array([ord(c) for c in text], np.uint32)
    ends = lz_fingerprint.phrases(points).tolist()
    assert [text[a:b] for a, b in zip([0, *ends], ends)] == _parse(text)


def test_phrases_of_random_texts():
    r = random.Random(8)
    for _ in range(200):
        text = "".join(r.choice("ab c") for _ in range(r.randrange(300)))
        ends = lz_fingerprint.phrases(np.array([ord(c) for c in text], np.uint32)).tolist()
        assert [text[a:b] for a, b in zip([0, *ends], ends)] == _parse(text)


def test_likeness_follows_the_phrase_sets(spark):
    r = random.Random(4)
    words = [f"w{k}" for k in range(90)]
    texts = [" ".join(r.choice(words[:n]) for _ in range(400)) for n in (20, 20, 90, 90)] + ["", "one"]
    rows = lz_fingerprint.lz_fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), blocks=2).collect()
    assert len(rows) == len(texts)
    for row in rows:
        own, following = texts[row.doc_id], texts[(row.doc_id + 1) % len(texts)]
        edited = own[:len(own) - len(own) // 2] + following[:len(own) // 2]
        lanes = [row.fingerprint[k:k + 4] == row.edited_fingerprint[k:k + 4] for k in range(0, 512, 4)]
        assert row.near_edited == sum(lanes) / 128
        for near, other in ((row.near_edited, edited), (row.near_next, following)):
            a, b = set(_parse(own)), set(_parse(other))
            share = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(near - share) < 5 * math.sqrt(max(share * (1 - share), 0.01) / 128)
