"""Groups of linked classes that no task may hold."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from test_text_operators import brute_groups
from tripweave.llm import shingle_join, text_bytes


def chain(n: int, seed: int = 5) -> dict[int, str]:
    """Texts that share two thirds with each neighbour, none of them linked, and a near copy of each."""
    draw = random.Random(seed)
    passages = [[f"p{i}x{j}" for j in range(10)] for i in range(2 * n + 4)]
    texts = {i: sum(passages[2 * i:2 * i + 6], []) for i in range(n)}
    for i in range(n):
        copy = list(texts[i])
        copy[draw.choice((0, -1))] = f"new{i}"
        texts[n + i] = copy
    return {k: " ".join(words) for k, words in texts.items()}


def grouped(rows, texts):
    docs = rows.of("doc_id long, text string", *texts.items())
    sets = shingle_join.shared_shingles(docs).dropDuplicates(["class"]).cache()
    held = sets.join(shingle_join.candidate_groups(sets), F.col("class") == F.col("node"))
    total = F.sum(F.octet_length("hashes") / 8).cast("long")
    roots = held.groupBy("root").agg(total.alias("_postings"))
    return docs, held.join(roots, "root").select("root", "class", "n", "hashes", "_postings")


def test_a_chain_of_unlike_texts_is_cut_by_shingle(rows):
    texts = chain(60)
    docs, held = grouped(rows, texts)
    longest = held.orderBy(F.desc("_postings")).first()
    assert held.where(F.col("root") == F.lit(bytes(longest["root"]))).count() > 60  # shared passages join nearly all
    marked = held.where(F.col("root") == F.lit(bytes(longest["root"]))).withColumn("_rest", F.lit(True))
    postings = longest["_postings"]
    dealt = shingle_join.units(marked, 500)
    sent = dealt.agg(F.sum(F.octet_length("hashes") / 8 * F.col("_blocks"))).first()[0]
    blocks = -(-postings // 250)
    assert sent < 8 * postings < 2 * blocks * postings / 4
    assert dealt.select("_unit").distinct().count() > 20 and dealt.agg(F.max("_blocks")).first()[0] == 1
    expected = brute_groups(texts)
    got = {r["doc_id"]: r["component_id"] for r in shingle_join.find_groups(docs, group_postings=500).collect()}
    assert got == expected


def test_links_of_a_large_group_whose_pivots_have_none(rows):
    for linked in ((7,), (20, 41)):
        texts = {k: text for k, text in chain(60).items() if k < 60 or k - 60 in linked}
        docs, held = grouped(rows, texts)
        assert held.agg(F.max("_postings")).first()[0] > 500
        got = {r["doc_id"]: r["component_id"] for r in shingle_join.find_groups(docs, group_postings=500).collect()}
        assert got == brute_groups(texts) and all(got[60 + k] == k for k in linked)


def test_common_shingles_go_by_blocks(rows):
    draw = random.Random(2)
    base = [f"b{i}" for i in range(60)]
    texts = {}
    for i in range(80):  # nearly all hold the same shingles, and the rest differs from the pivots
        words = list(base)
        for _ in range(2):
            words[draw.randrange(60)] = f"v{draw.randrange(12)}"
        texts[i] = " ".join(words)
    docs, held = grouped(rows, texts)
    marked = held.withColumn("_rest", F.pmod(F.xxhash64("class"), F.lit(3)) == 0)
    dealt = shingle_join.units(marked, 1500)
    assert dealt.where("not contains(_unit, '-')").count() > 0 and dealt.where("contains(_unit, '-')").count() == 0
    got = {r["doc_id"]: r["component_id"] for r in shingle_join.find_groups(docs, group_postings=1500).collect()}
    assert got == brute_groups(texts)


def test_many_short_texts_in_one_batch(spark, monkeypatch):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "0")
    try:
        n = 70_000
        docs = (spark.range(2 * n).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % n).cast("string")).alias("text"))
                .coalesce(1))
        got = shingle_join.find_groups(docs)
        wrong = got.where((F.col("component_id") != F.col("doc_id") % n) | (F.col("n_shingles") != 1))
        assert got.count() == 2 * n and wrong.isEmpty()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_slices_of_rows_change_no_set():
    texts = pa.array(["a b c d e f", None, "", "x y", "A b C d E f g"] * 50)
    flat, where = shingle_join.shingle_sets(texts)
    for i in (0, 3, 4, 249):
        alone, _ = shingle_join.shingle_sets(texts.slice(i, 1))
        assert np.array_equal(alone, flat[where[i]:where[i + 1]])


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    draw = random.Random(4)
    texts = ["", " \n ", "w " * 400, "x" * 900, "one  two", "É" * 300 + " a b c d " + "ü" * 300,
             " ".join("q" * draw.randrange(1, 150) for _ in range(300)) + "\n", "\t" * 500 + "a b c d e f" + " " * 500]
    for text in texts:
        column = pa.array([text])
        whole, _ = text_bytes._shingle_sets(column, 5)
        for piece in (7, 64, 100_000):
            assert np.array_equal(text_bytes._long_shingle_set(column, 5, piece), whole)
    monkeypatch.setattr(text_bytes, "SLICE_BYTES", 400)
    flat, where = text_bytes.shingle_sets(pa.array(texts))
    for i, text in enumerate(texts):
        assert np.array_equal(flat[where[i]:where[i + 1]], text_bytes._shingle_sets(pa.array([text]), 5)[0])


def test_a_text_of_50_megabytes():
    column = pa.array(["word%07d " % 1 * 2_000_000 + "long" * 7_000_000 + " " + " ".join(str(i) for i in range(500_000))])
    tracemalloc.start()
    flat, where = text_bytes.shingle_sets(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # One repeated word, four shingles around each of the two seams' sides, and the counted numbers.
    assert len(flat) == where[-1] == 1 + 4 + 1 + 500_000 - 5 + 1
    assert peak < 400 << 20
