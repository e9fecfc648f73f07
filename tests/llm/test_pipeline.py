"""The pipeline's stages against brute-force versions, each on its own input."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

import corpus_pipeline  # noqa: E402
from test_text_operators import brute_groups  # noqa: E402
from tripweave.llm import quality_classifier  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars int, _text string, `a.b` int"


def corpus() -> dict[int, str | None]:
    rng = random.Random(11)
    def prose(n):
        return " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    texts: dict[int, str | None] = {i: prose(rng.randrange(60, 200)) for i in range(1, 41)}
    for i in range(41, 61):  # near copies: one word of an earlier text changed
        words = texts[i - 40].split()
        words[rng.randrange(len(words))] = "changed"
        texts[i] = " ".join(words)
    texts |= {i: texts[i - 60] for i in range(61, 71)}  # exact copies
    texts |= {i: "### $$$ *** buy now " * 20 + f"%%% {i}" for i in range(71, 91)}  # junk
    texts |= {91: None, 92: "", 93: "short text", 94: " \n\t", 95: "same three words " * 60, 96: prose(30_000)}
    texts |= {97: "\n".join(["a line that is said again and again"] * 30 + [prose(80)]), 98: prose(60).upper()}
    return texts


def rejected(text: str | None) -> bool:
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    n, chars = len(words), sum(map(len, words))
    windows = Counter(tuple(words[i:i + 3]) for i in range(n - 2))
    inside = {j for i in range(n - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = text.split("\n")
    with_word = [line for line in lines if re.search("[^\x20\x09-\x0D]", line)]
    return (
        n < 50 or 100 * len(inside) > 50 * n
        or 100 * len(re.findall(r"[#*$%&|<>]", text)) > 30 * n
        or 100 * (len(with_word) - len(set(with_word))) > 50 * len(lines)
        or 100 * sum(c.isupper() for c in text) > 60 * chars
        or chars < 1.5 * n or chars > 20 * n)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path, texts = str(tmp_path_factory.mktemp("corpus")), corpus()
    spark.createDataFrame(
        [(k, t, "en", "s", len(t or ""), "clash", 1) for k, t in texts.items()] + [(5, texts[5], "en", "s", 1, "clash", 1)], DOCS,
    ).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(
        [(k, int(k <= 70), 0) for k in texts if k <= 90], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def ids(docs) -> list:
    return sorted(r["doc_id"] for r in docs.select("doc_id").collect())


def test_stages_equal_brute_force(spark, folder):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    texts, docs = corpus(), spark.read.parquet(f"{folder}/documents.parquet")
    stages = [stage for _, stage in corpus_pipeline.STAGES]

    kept = stages[0](spark, docs, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    learned = spark.createDataFrame([r for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 5], "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(docs, learned)
    scored = docs.select("doc_id", quality_classifier.score_column(docs, model).alias("s")).collect()
    assert kept.columns == docs.columns and ids(kept) == sorted(r["doc_id"] for r in scored if r["s"] >= 0.3)
    assert not set(range(71, 91)) & set(ids(kept)) and set(range(1, 71)) <= set(ids(kept))

    kept = stages[1](spark, docs, folder)  # from here on also the rows that an earlier stage would drop
    assert kept.columns == docs.columns
    assert ids(kept) == sorted([k for k in texts if not rejected(texts[k])] + [5])

    kept = stages[2](spark, docs, folder)
    last = {t or "": k for k, t in sorted(texts.items())}
    assert kept.columns == docs.columns and ids(kept) == sorted(last.values())

    kept = stages[3](spark, docs.dropDuplicates(["doc_id"]), folder)
    assert kept.columns == docs.columns
    assert ids(kept) == sorted(k for k, group in brute_groups(texts).items() if k == group)


def test_packed_pieces_hold_every_token_once(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").dropDuplicates(["doc_id"])
    rows = corpus_pipeline.pack_sequences(spark, docs, folder).collect()
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    texts = corpus()
    assert set(pieces) == set(texts)
    for k, text in texts.items():
        tokens = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        cut = [tokens[i:i + 2048] for i in range(0, len(tokens), 2048)]
        got = sorted(pieces[k], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got] == [
            (i, 2048 * i, len(c), zlib.crc32(c.tobytes())) for i, c in enumerate(cut)]
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_applies_all_stages_in_order(spark, folder, tmp_path):
    texts = corpus()
    got = set(ids(corpus_pipeline.run(spark, folder)))
    good = [k for k in texts if k <= 70 and not rejected(texts[k])]
    last = {texts[k]: k for k in good}
    groups = brute_groups({k: texts[k] for k in last.values()})
    expected = {k for k, group in groups.items() if k == group}
    assert {k for k in got if k <= 70} == expected and not got & {*range(71, 96)} and 96 in got

    empty = str(tmp_path)
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_near_copies_leave_one_row_whatever_their_ids(spark, folder):
    near, other = " ".join(f"a{i}" for i in range(80)), " ".join(f"b{i}" for i in range(80))
    third = " ".join(f"c{i}" for i in range(80))
    made = [(7, near + " x"), (7, near + " y"), (3, near), (3, near), (7, other), (None, other + " x"), (None, third),
            (None, third + " x"), (None, third), (9, None), (9, "")]
    docs = spark.createDataFrame([(k, t, "en", "s", 1, f"{n}", n) for n, (k, t) in enumerate(made)], DOCS).repartition(3)
    kept = corpus_pipeline.STAGES[3][1](spark, docs, folder)
    got = kept.collect()
    assert kept.columns == docs.columns and all(r["_text"] == str(r["a.b"]) for r in got)
    assert sorted(str(r["doc_id"]) for r in got) == ["3", "7", "9", "9", "None"]
    assert {r["a.b"] for r in got} - {2, 3, 6, 7, 8} == {4, 9, 10}


def test_near_copies_of_repeated_ids_equal_brute_force(spark, folder):
    texts, docs = corpus(), spark.read.parquet(f"{folder}/documents.parquet")  # doc_id 5 stands there twice
    kept = corpus_pipeline.STAGES[3][1](spark, docs, folder)
    assert ids(kept) == sorted(k for k, group in brute_groups(texts).items() if k == group)
