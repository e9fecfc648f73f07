"""Phrase mining against plain counting, and the summaries' guarantee."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from tripweave.llm import phrases, queries

SCHEMA = "doc_id long, text string, lang string, phrase string, n int"


def brute(docs: list[tuple], threshold: int, top: int) -> list[tuple]:
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= threshold}
        hidden = {
            p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * a >= 80 * counts[p[i:j]]}
        rows = []
        for p, a in candidates.items():
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if p not in hidden:
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out, key=repr)


def corpus(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(14)] + ["É", "Big", "x\x00y"]
    def text():
        return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", " . ", "\n", ", "]) for _ in range(rng.randrange(60)))
    made = [(i, text(), rng.choice(["en", "de", None, "und"])) for i in range(300)]
    return made + [(1, None, "en"), (2, "", None), (3, " \n.", "fr"), (4, "one Hot phrase " * 400, "en"), (4, "one Hot phrase " * 400, "en")]


def test_phrases_equal_plain_counting(rows, monkeypatch):
    docs = corpus(1)
    frame = rows.of(SCHEMA, *((*d, "clash", 1) for d in docs))
    for threshold, top in ((30, 2000), (12, 5)):
        assert rows.back(phrases.mine(frame, threshold=threshold, top=top)) == brute(docs, threshold, top)
    assert phrases.mine(frame.limit(0)).count() == 0


def test_long_texts_are_cut_between_pieces():
    text = "some words here. and more, " * 5000 + "x " * 3000
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"_lang": ["en", "de"], "_text": [text, "a b"]})
    old = phrases.CHUNK_BYTES
    try:
        whole = sum((Counter(map(int, h)) for c in phrases.chunks(iter([batch]), 4) for h in c.hashes), Counter())
        phrases.CHUNK_BYTES = 1000
        parts = list(phrases.chunks(iter([batch]), 4))
    finally:
        phrases.CHUNK_BYTES = old
    assert len(parts) > 100 and sum((Counter(map(int, h)) for c in parts for h in c.hashes), Counter()) == whole


def test_no_frequent_entry_is_lost():
    rng = np.random.default_rng(3)
    for seed in range(20):
        drawn = np.minimum(rng.zipf(1.3, 20_000), 5_000).astype(np.uint32)
        threshold, mass = 40, len(drawn)
        merged = phrases.Summary(phrases.capacity(mass, threshold))
        for part in np.array_split(drawn, 17):
            keys, counts = np.unique(part, return_counts=True)
            keys, counts, off = phrases.reduced(keys, counts, merged.entries)
            merged.add(keys, counts, off)
            merged.merge()
        assert len(merged.keys) <= merged.entries and merged.taken < threshold
        values, counts = np.unique(drawn, return_counts=True)
        assert set(values[counts >= threshold].tolist()) <= set(merged.survivors(threshold).tolist())


def test_query_columns(spark):
    got = queries.QUERIES["op12_phrase_collocations"](spark, "/root/testdata/sf0.001")
    assert got.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *((c, "bigint") for c in ("a", "l", "r", "n", "score"))]
