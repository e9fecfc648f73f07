"""Registered queries against their stated columns, and votes and laws against plain versions."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from tripweave.llm import quality_classifier, queries

DATA = "/root/testdata/sf0.001"


def held(doc_id: int, parts: int, remainder: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % parts == remainder


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}


def answer(spark, name):
    frame = queries.QUERIES[name](spark, DATA)
    return dict(frame.dtypes), {r["doc_id"]: r for r in frame.collect()}


def test_shards(spark, documents):
    types, got = answer(spark, "op3_hypergeometric_sharding")
    assert types["size"] == types["text_crc32"] == "bigint" and got.keys() == documents.keys()
    for k, text in documents.items():
        raw = (text or "").encode()
        assert (got[k]["size"], got[k]["text_crc32"], got[k]["law"], got[k]["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    slots = [sorted(r["slot"] for r in got.values() if r["shard"] == s) for s in range(16)]
    assert all(s == list(range(len(s))) for s in slots) and max(map(len, slots)) - min(map(len, slots)) <= 1


def test_languages_of_held_out_documents(spark, documents):
    types, got = answer(spark, "op7_zstd_language")
    assert (types["held_out"], types["lang_pred"], types["score"]) == ("boolean", "string", "double") and got.keys() == documents.keys()
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()}
    right = []
    for k, r in got.items():
        assert r["held_out"] == held(k, 4, 2) and 0 <= r["score"] <= 1
        has_letter = any(c.isalpha() for c in documents[k] or "")
        assert (r["lang_pred"] == "und") == (not has_letter)
        if r["held_out"] and has_letter and langs[k]:
            right.append(r["lang_pred"] == langs[k])
    assert np.mean(right) > 0.9


def test_quality_of_held_out_documents(spark, documents):
    types, got = answer(spark, "op8_lsa_neighbours")
    assert (types["held_out"], types["score"], types["predicted"]) == ("boolean", "double", "int") and got.keys() == documents.keys()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    for k, r in got.items():
        assert r["held_out"] == held(k, 5, 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    scores = {q: [r["score"] for k, r in got.items() if r["held_out"] and labels.get(k) == q] for q in (0, 1)}
    assert np.mean([a > b for a in scores[1] for b in scores[0]]) > 0.9


def test_votes_equal_plain_cosines():
    import math

    import pyarrow as pa

    texts = [f"{'Good words here. ' * (i % 5 + 1)}{chr(97 + i % 26) * (i % 7)} number {i * i}" if i % 2 else f"BUY now!!! {i} " * (i % 6 + 1) for i in range(60)]
    counts = quality_classifier.term_counts(pa.array(texts))
    model = quality_classifier.fit_rows(counts, [i % 2 for i in range(60)], 8)
    asked = ["Good words there.", "BUY BUY", "", None, texts[7], "é" * 300]
    got = quality_classifier.scores_of(pa.array(asked), model)
    for text, score in zip(asked, got):
        terms = quality_classifier.term_counts(pa.array([text], pa.string()))[0]
        vector = [float(sum(t * p for t, p in zip(terms[terms != 0], column[terms != 0]))) for column in model.projection.T]
        length = math.sqrt(sum(v * v for v in vector))
        if not length:
            assert score == model.prior
            continue
        cosines = sorted(((sum(a * b for a, b in zip(vector, row)) / length, label) for row, label in zip(model.vectors, model.labels)), reverse=True)
        near = [(max(c, 0) ** model.sharpness, label) for c, label in cosines[:model.neighbours]]
        assert score == pytest.approx(sum(w * label for w, label in near) / sum(w for w, _ in near), abs=0.02)


def test_matrix_follows_the_enumerated_law():
    import itertools
    from collections import Counter

    from tripweave.llm import sharding

    # All ways to put six rows, three and two and one by partition, on two shards of three, counted by hand.
    owner = [0, 0, 0, 1, 1, 2]
    ways = Counter()
    for first in itertools.combinations(range(6), 3):
        ways[tuple(sum(owner[i] == p for i in first) for p in range(3))] += 1
    drawn = Counter(tuple(int(sent[0]) for _, sent in sorted(sharding.communication_matrix({0: 3, 1: 2, 2: 1}, 2, seed).items()))
                    for seed in range(6000))
    assert drawn.keys() == ways.keys()
    assert sum((drawn[k] - 6000 * n / 20) ** 2 / (6000 * n / 20) for k, n in ways.items()) < 25
