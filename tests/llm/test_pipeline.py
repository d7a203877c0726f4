"""Each stage of the corpus pipeline, on what the one before wrote, against plain Python."""

import random

from corpus_pipeline import KEEP, STAGES
from ledgerflow.llm import fpe_pii, packing, quality_gam
from ledgerflow.llm.queries import tokenizer

from .test_operators import WORD, texts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def near_duplicates(docs: dict) -> dict:
    low = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
    sets = {}
    for k, t in docs.items():
        w = WORD.findall((t or "").translate(low))
        sets[k] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    up = {k: k for k in sets}
    for _ in sets:
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
    return {k: t for k, t in docs.items() if up[k] == k}


def substrings(docs: dict) -> dict:
    seen, out = set(), {}
    for k, t in sorted(docs.items()):
        w = WORD.findall(t or "")
        gone = set()
        for i in range(len(w) - 19):
            x = tuple(w[i:i + 20])
            if x in seen:
                gone.update(range(i, i + 20))
            seen.add(x)
        left = [x for i, x in enumerate(w) if i not in gone]
        if left:
            out[k] = left
    return out


def test_stages(spark, tmp_path):
    r = random.Random(9)
    words = [f"word{k}" for k in range(300)]
    all_texts, labels = texts(), []
    all_texts[11] = "la " * 60  # repeats itself
    all_texts += [" \n ".join(texts()[10].split(" ")), texts()[9] + " 12 4111111111111111"]
    for k in range(240):
        w = [r.choice(words) for _ in range(40)]
        all_texts.append(" ".join([x.upper() + "!!" for x in w] if k % 3 == 0 else w))
        labels.append((len(all_texts) - 1, int(k % 3 != 0)))
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(all_texts)]
    folder = str(tmp_path)
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {}
    before = dict(enumerate(all_texts))
    score = {x.doc_id: x.score for x in quality_gam.quality(docs.select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    for name, stage in STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            taken = docs.collect()
            got[name] = {x.doc_id: x.text for x in taken}
            assert len(got[name]) == len(taken) and all(x.n_chars == (None if x.text is None else len(x.text)) for x in taken)
        if name == "quality":
            assert got[name] == {k: t for k, t in before.items() if score[k] >= KEEP} and 0 < len(got[name]) < len(before)
        elif name == "near_duplicates":
            assert got[name] == near_duplicates(before) and len(got[name]) < len(before)
        elif name == "substrings":
            assert {k: WORD.findall(t) for k, t in got[name].items()} == substrings(before)
        elif name == "personal_data":
            move = fpe_pii.Feistel(fpe_pii.KEY).permute
            assert got[name] == {k: fpe_pii.pseudonymise(t, move) for k, t in before.items()}
        else:
            plain, length = packing.encoder(tokenizer("byte_bpe_50k.json")).tokenizer, {}
            for x in docs.collect():
                length[x.doc_id] = length.get(x.doc_id, 0) + x.length
            assert length == {k: len(plain.encode(t, add_special_tokens=False).ids) + 1 for k, t in before.items()}
        before = got.get(name)
