"""BPE encoding and decoding of whole texts, long ones by tree concatenation.

``WordwiseEncoder`` encodes a text exactly as the tokenizers library does, word by word: the
pre-tokenizers of both vocabularies never join characters across the places where it cuts, so the
ids of a text are the ids of its words one after another, and the ids of a word may be remembered.
A text that holds a special token, and any word too long to remember, goes to the library whole.

``encode_tree`` handles text that is longer than a leaf: it is halved down to leaves, the
leaves are encoded independently (``encode_documents`` spreads those of long documents over
tasks), and halves are joined by re-encoding a growing window of tokens around each join until
its first and last token are the ones that both sides already had. A sequence of tokens is the
encoding of its text exactly if all neighbouring pairs are, and after agreement every pair has
been produced by an encoder, so the result equals encoding in one piece.

Defined results: null and empty texts have no ids; repeated rows are encoded alike; an empty
table gives an empty table; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.text_bytes import slices, texts

LEAF_CHARS = 8_192
SPREAD_CHARS = 65_536
REMEMBERED_WORDS = 400_000
LONGEST_REMEMBERED = 64

# The white space that both vocabularies' pre-tokenizers split at.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A space stays with the word after it; of longer white space the last character stays apart.
_WORD_WITH_SPACE = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")
_WORD = re.compile("[^ \t\n\r]+")
# Letters of Latin-1; between them and its other signs both pre-tokenizers cut.
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_FINE_WITH_SPACE = re.compile(f" ?[{_LETTER}]+| ?[^{_LETTER}{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")
_FINE = re.compile(f"[{_LETTER}]+|[^{_LETTER}{WHITE_SPACE}]+")
_SAFE_CUT = re.compile(f"(?<=[^{WHITE_SPACE}]) (?=[^{WHITE_SPACE}])")


class WordwiseEncoder:
    """Ids as little-endian 32-bit bytes. ``keeps_space``: byte-level (True) or word (False) BPE.

    Texts of Latin-1 without an apostrophe are cut finer, between letters and other signs, as both
    pre-tokenizers cut there; for word BPE they are lower-cased first, as its normalizer does.
    Other texts are cut at white space only.
    """

    def __init__(self, path: str, keeps_space: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special_texts = [t.content for t in added.values()]
        self.special = re.compile("|".join(map(re.escape, self.special_texts)) or "(?!)")
        self.separator, self.separator_id = next(((t.content, i) for i, t in added.items()), (None, -1))
        self.lower = not keeps_space
        self.find = (_WORD_WITH_SPACE if keeps_space else _WORD).findall
        self.find_fine = (_FINE_WITH_SPACE if keeps_space else _FINE).findall
        self.known: dict[str, bytes] = {}

    def direct(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def _cut(self, text: str) -> list[str] | None:
        """The words of a text; None if it holds a special token."""
        if any(token in text for token in self.special_texts):
            return None
        if "'" in text:
            return self.find(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.find(text)
        return self.find_fine(text.lower() if self.lower else text)

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word. Many go to the library as one text, parted by a special token, which
        it encodes apart from what stands around it."""
        if self.separator is None:
            return [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        joined = [self.separator.join(words[i:i + 64]) for i in range(0, len(words), 64)]
        out = []
        for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array(e.ids, "<u4")
            held, at = ids.tobytes(), 0
            for cut in (np.flatnonzero(ids == self.separator_id) * 4).tolist():
                out.append(held[at:cut])
                at = cut + 4
            out.append(held[at:])
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        plain = [self._cut(text) for text in texts]
        used = set().union(*filter(None, plain))
        known = self.known
        missing = list(used.difference(known))
        if len(known) + len(missing) > REMEMBERED_WORDS:
            # Words met first are the frequent ones; the later half is forgotten.
            self.known = known = dict(islice(known.items(), REMEMBERED_WORDS // 2))
            missing = list(used.difference(known))
        known.update(zip(missing, self._encode_words(missing)))
        out = [self.direct(t) if w is None else b"".join(map(known.__getitem__, w)) for t, w in zip(texts, plain)]
        for word in missing:
            if len(word) > LONGEST_REMEMBERED:
                del known[word]
        return out


@lru_cache(maxsize=4)
def encoder_of(path: str, keeps_space: bool) -> WordwiseEncoder:
    """One encoder per worker process and vocabulary: what it remembers serves later tasks."""
    return WordwiseEncoder(path, keeps_space)


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary (special tokens: their own text)."""
    tokenizer = encoder_of(path, True).tokenizer
    visible = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    hidden = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    added = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
    table = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        table[i] = added[i].encode() if i in added else bytes(byte_of[c] for c in token)
    return table


def decode_ids(ids: bytes, table: list[bytes]) -> str:
    """Text of the ids, malformed bytes replaced as the library's byte-level decoder does."""
    return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def halves(text: str, leaf_chars: int = LEAF_CHARS, special: re.Pattern | None = None) -> list[str]:
    """The leaves of the halving tree, left to right.

    A cut goes to a single space between words near the middle, if there is one; unsplit text is
    cut in its middle. Special tokens are never cut.
    """
    if len(text) <= leaf_chars:
        return [text]
    middle, reach = len(text) // 2, len(text) // 4
    cut = _SAFE_CUT.search(text, middle, middle + reach)
    at = cut.start() if cut else middle
    if special is not None and not cut:
        for token in special.finditer(text, max(0, at - 64), at + 64):
            if token.start() < at < token.end():
                at = token.start()
    if not 0 < at < len(text):
        return [text]
    return halves(text[:at], leaf_chars, special) + halves(text[at:], leaf_chars, special)


def join_halves(left: bytes, right: bytes, encode: Callable[[str], bytes], table: list[bytes]) -> bytes:
    """The ids of the joined text, from those of its two parts.

    The window takes 1, 2, 4, ... tokens of each side. It is accepted once its encoding
    begins with the window's first old token and ends with its last, or reaches the text's end on
    a side. A window edge inside a character or after white space grows further.
    """
    if not left or not right:
        return left + right
    k = 1
    while True:
        a, b = left[-4 * k:], right[:4 * k]
        at_start, at_end = len(a) == len(left), len(b) == len(right)
        joined = b"".join(map(table.__getitem__, np.frombuffer(a + b, "<u4").tolist()))
        try:
            text = joined.decode("utf-8")
        except UnicodeDecodeError:
            text = None
            if at_start and at_end:
                raise
        if text is not None and (at_end or not text[-1].isspace()):
            middle = encode(text)
            if (at_start or middle[:4] == a[:4]) and (at_end or middle[-4:] == b[-4:]):
                return left[:len(left) - len(a)] + middle + right[len(b):]
        k *= 2


def join_tree(parts: list[bytes], encode: Callable[[str], bytes], table: list[bytes]) -> bytes:
    """Neighbours are joined pair by pair until one sequence is left."""
    while len(parts) > 1:
        parts = [
            join_halves(parts[i], parts[i + 1], encode, table) if i + 1 < len(parts) else parts[i]
            for i in range(0, len(parts), 2)]
    return parts[0] if parts else b""


def encode_tree(whole_texts: list[str], path: str, leaf_chars: int = LEAF_CHARS) -> list[bytes]:
    """Byte-level ids of whole texts; all leaves of all texts are encoded together."""
    encoder, table = encoder_of(path, True), token_bytes(path)
    leaves = [halves(text, leaf_chars, encoder.special) for text in whole_texts]
    encoded = iter(encoder.encode_batch([leaf for parts in leaves for leaf in parts]))
    return [join_tree([next(encoded) for _ in parts], encoder.direct, table) for parts in leaves]


def _identity(ids: list[bytes]) -> list[pa.Array]:
    return [pa.array(ids, pa.binary())]


def encode_documents(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
    leaf_chars: int = LEAF_CHARS, spread_chars: int = SPREAD_CHARS,
    describe: Callable[[list[bytes]], list[pa.Array]] = _identity, columns: str = "ids binary",
) -> DataFrame:
    """``doc_id, ids`` (binary, little-endian 32-bit) of every whole text.

    Texts up to ``spread_chars`` are encoded where they are read, with no shuffle. The leaves of
    longer ones become rows, are encoded in whatever task they reach, and meet again per document
    to be joined; only those texts move. ``describe`` turns the ids of some documents into other
    ``columns`` in the same task, so that the ids need not leave it.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    is_long = F.length("_text") > spread_chars
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *(c.split()[0] for c in columns.split(", "))]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            ids = encode_tree(texts(part, "_text"), path, leaf_chars)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *describe(ids)], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = encoder_of(path, True).special
        for part in slices(batches, "_text"):
            for row, long_text in enumerate(texts(part, "_text")):
                leaves = halves(long_text, leaf_chars, special)
                one = part.slice(row, 1)
                n = len(leaves)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.column("doc_id").to_pylist() * n, one.schema.field("doc_id").type),
                     pa.array(one.column("_row").to_pylist() * n, pa.int64()),
                     pa.array(range(n), pa.int32()), pa.array(leaves, pa.string())],
                    names=["doc_id", "_row", "_leaf", "_part"])

    def leaf_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, True)
        for part in slices(batches, "_part"):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("_row"), part.column("_leaf"),
                 pa.array(encoder.encode_batch(texts(part, "_part")), pa.binary())],
                names=["doc_id", "_row", "_leaf", "_ids"])

    def joined(leaves: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("_leaf")
        ids = join_tree(leaves.column("_ids").to_pylist(), encoder_of(path, True).direct, token_bytes(path))
        return pa.table([leaves.column("doc_id").slice(0, 1), *describe([ids])], names=names)

    short = rows.where(~is_long).mapInArrow(whole, f"doc_id {id_type}, {columns}")
    spread = (
        rows.where(is_long).withColumn("_row", F.monotonically_increasing_id())
        .mapInArrow(cut, f"doc_id {id_type}, _row long, _leaf int, _part string")
        .repartition(F.col("_row"), F.col("_leaf"))
        .mapInArrow(leaf_ids, f"doc_id {id_type}, _row long, _leaf int, _ids binary")
        .groupBy("_row").applyInArrow(joined, f"doc_id {id_type}, {columns}"))
    return short.unionByName(spread)


def encode_and_decode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids and of their decoding."""
    def digests(ids: list[bytes]) -> list[pa.Array]:
        table = token_bytes(path)
        return [pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(decode_ids(i, table).encode()).hexdigest() for i in ids], pa.string())]

    return encode_documents(
        docs, path, doc_id, text, describe=digests,
        columns="n_tokens long, ids_sha256 string, decoded_sha256 string", **sizes)
