"""BPE operators against the tokenizers library."""

from __future__ import annotations

import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from tripweave.llm import bpe  # noqa: E402

BYTE, WORD = (public_tokenizers.path(f"{name}.json") for name in ("byte_bpe_50k", "word_bpe_49k"))
PIECES = [
    "the", "The", "hello", "don't", "'s", "l'été", "ÉTÉ", "Ünïcode", "naïve,", "x²", "½", "12", "3456", "!!", "***", "|", ".",
    " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x85", "\xa0", " ", "　", "\x1c", "​", "日本語", "Σας", "İ", "é", "👩‍🚀",
    "<|endoftext|>", "<|startoftext|>", "<|", "aaaaaaaa", "abcabc", "\xad", "µ", "ª", "ß", "\x00",
]


def ids(path: str, text: str) -> bytes:
    tokenizer = tokenizers.Tokenizer.from_file(path)
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def made(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return "".join(rng.choice(PIECES) + rng.choice(["", " ", " "]) for _ in range(n))


TEXTS = ["", " ", "\n", "a", "  a  b ", *(made(s, 40) for s in range(120)), *(made(s, 3).replace("'", "") for s in range(400, 700))]


@pytest.mark.parametrize("path, keeps_space", [(BYTE, True), (WORD, False)])
def test_wordwise_encoding_is_the_librarys(path, keeps_space):
    tokenizer = tokenizers.Tokenizer.from_file(path)
    expected = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(TEXTS, add_special_tokens=False)]
    encoder = bpe.WordwiseEncoder(path, keeps_space)
    assert encoder.encode_batch(TEXTS) == expected
    assert encoder.encode_batch(TEXTS) == expected  # from memory


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 10)
    encoder = bpe.WordwiseEncoder(BYTE, True)
    for text in TEXTS[:60]:
        assert encoder.encode_batch([text]) == [ids(BYTE, text)]


@pytest.mark.parametrize("leaf", [4, 9, 33])
def test_tree_equals_encoding_in_one_piece(leaf):
    unsplit = ["a" * 300, "ab" * 111, "!?" * 90 + "x" * 50, "\n" * 77 + "abc", " " * 50, "日本語" * 40, "é" * 99, "don't" * 30]
    texts = [*TEXTS[:80], *unsplit, *("".join(random.Random(s).choices("ab'st \n", k=200)) for s in range(40))]
    tokenizer = tokenizers.Tokenizer.from_file(BYTE)
    expected = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for text, got, want in zip(texts, bpe.encode_tree(texts, BYTE, leaf), expected):
        assert got == want, repr(text)


def test_documents_short_and_spread(spark, rows):
    texts = [None, "", "one text", "one text", made(1, 900), "x" * 5000, "word " * 3000]
    docs = rows.of("doc_id long, text string, ids string, _row int", *((i, t, "clash", 1) for i, t in enumerate(texts)))
    got = {r["doc_id"]: bytes(r["ids"]) for r in bpe.encode_documents(docs, BYTE, leaf_chars=128, spread_chars=1000).collect()}
    assert got == {i: ids(BYTE, t or "") for i, t in enumerate(texts)}
    digests = bpe.encode_and_decode(docs, BYTE, spread_chars=1000).collect()
    tokenizer = tokenizers.Tokenizer.from_file(BYTE)
    import hashlib
    for r in digests:
        known = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(known)
        assert r["decoded_sha256"] == hashlib.sha256(tokenizer.decode(known, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_and_decode(docs.limit(0), BYTE).count() == 0
