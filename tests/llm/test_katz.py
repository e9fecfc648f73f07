"""Katz scoring against a plain version of the recursion, and its exact normalisation."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tripweave.llm import katz, queries

SCHEMA = "doc_id long, text string, row int, n_tokens string, train boolean"
BEGIN, END = ("<",), (">",)


def words(text):
    return [*re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), END]


class Plain:
    def __init__(self, texts, order):
        self.order, self.grams = order, [Counter() for _ in range(order)]
        for text in texts:
            symbols = [BEGIN, *words(text)]
            for n in range(1, order + 1):
                for i in range(max(1, n - 1), len(symbols)):
                    self.grams[n - 1][tuple(symbols[i - n + 1:i + 1])] += 1
        self.kept, self.followers = [], [defaultdict(list) for _ in range(order)]
        for n, grams in enumerate(self.grams):
            n_of = Counter(grams.values())
            most = 6 * n_of[6] / n_of[1] if n_of[1] else 1
            kept = {}
            for r in range(1, 6):
                ratio = ((r + 1) * n_of[r + 1] / (r * n_of[r]) - most) / (1 - most) if n_of[r] and most < 1 else 0
                kept[r] = r * ratio if 0 < ratio < 1 else r - 0.5
            self.kept.append(kept)
            for gram in grams:
                self.followers[n][gram[:-1]].append(gram[-1])

    def share(self, n, gram):
        """Of a seen n-gram, and what its history leaves over."""
        counts = [self.grams[n][(*gram[:-1], w)] for w in self.followers[n][gram[:-1]]]
        spare = sum(r - self.kept[n].get(r, r) for r in counts)
        total = sum(counts) + (spare == 0)
        r = self.grams[n].get(gram, 0)
        return self.kept[n].get(r, r) / total, (spare or 1) / total

    def p(self, gram):
        n = len(gram) - 1
        if n == 0:
            if not self.grams[0]:
                return 1.0
            of, left = self.share(0, gram)
            return of if gram in self.grams[0] else left
        if gram in self.grams[n]:
            return self.share(n, gram)[0]
        followers = self.followers[n].get(gram[:-1])
        if not followers:
            return self.p(gram[1:])
        left = self.share(n, gram)[1]
        return left / (1 - sum(self.p((*gram[1:-1], w)) for w in followers)) * self.p(gram[1:])

    def score(self, text):
        symbols = [BEGIN, *words(text)]
        return sum(math.log10(self.p(tuple(symbols[max(0, i - self.order + 1):i + 1]))) for i in range(1, len(symbols)))


def corpus(seed, size=60):
    rng = random.Random(seed)
    made = [(i, " ".join(rng.choice([f"w{min(int(rng.expovariate(0.2)), 30)}", "The", "of"]) for _ in range(rng.randrange(40)))) for i in range(size)]
    return made + [(None, "the of w1"), (70, None), (71, ""), (72, " \n"), (73, "É new\x0bwords é"), (3, made[3][1]), (3, "w1 w2 w1"), (74, "united states " * 50)]


def held(key, most=4):
    return key is not None and zlib.crc32(str(key).encode()) % most == 0


def run(rows, docs, order=2, train=True):
    frame = rows.of(SCHEMA, *((k, t, 1, "clash", False) for k, t in docs)).repartition(3)
    trains = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 0, F.lit(True)) if train else F.lit(False)
    return katz.score(frame, trains, order)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_the_plain_recursion(rows, monkeypatch, order):
    docs = corpus(order)
    model = Plain([t for k, t in docs if not held(k)], order)
    c, total = model.grams[0], sum(model.grams[0].values())
    expected = []
    for k, t in docs:
        tokens = [(w,) for w in words(t)]
        base = sum(math.log10((c[w] + 0.1) / (total + 0.1 * (len(c) + 1))) for w in tokens)
        expected.append((str(k), len(tokens), sum(c[w] > 0 for w in tokens), total, base, model.score(t)))
    for size in (katz.BATCH_BYTES, 60):  # the second: many batches, texts cut
        monkeypatch.setattr(katz, "BATCH_BYTES", size)
        got = sorted((str(r[0]), *r[1:]) for r in run(rows, docs, order).drop("train").collect())
        assert [r[:4] for r in got] == [r[:4] for r in sorted(expected)]
        for a, b in zip(got, sorted(expected)):
            assert a[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)


def test_probabilities_sum_to_one():
    model = Plain([t for _, t in corpus(5)], 3)
    for history in [(), BEGIN, ("the",), ("w1", "of"), (BEGIN, "the"), ("united", "states"), ("never", "seen")]:
        history = tuple(h if isinstance(h, (str, tuple)) else h for h in history)
        assert sum(model.p((*history[-2:], w)) for (w,) in model.grams[0]) + model.p((*history[-2:], "unknown")) == pytest.approx(1)


def test_no_training_rows_and_empty_table(rows):
    got = run(rows, corpus(1), train=False).collect()
    assert all(r["train_tokens"] == r["n_known"] == 0 and r["score"] == r["base_score"] == 0 for r in got) and len(got) == 68
    assert run(rows, []).count() == 0


def test_long_texts_are_cut_between_words():
    for text in ("ab cd  e " * 500, "x" * 3000, "é" * 900 + " b", " " * 2000, "a b " + "y" * 1500 + " c d"):
        pieces = list(katz._cut(text, 3, 100))
        assert "".join(p for p, _, _ in pieces) == text and [last for _, _, last in pieces] == [False] * (len(pieces) - 1) + [True]
        assert [w for p, _, _ in pieces for w in p.split()] == text.split()


def test_query_columns(spark):
    got = queries.QUERIES["op13_katz_scoring"](spark, "/root/testdata/sf0.001")
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"), ("train_tokens", "bigint"),
                          ("base_score", "double"), ("score", "double")]
