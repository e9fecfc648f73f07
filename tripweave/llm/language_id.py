"""Language identification by compression with one raw-content dictionary per language.

A text is compressed once per language with a zstandard dictionary of that language's text; the
language that needs the fewest bytes is chosen. A margin under ``min_margin`` of the
best size is marked as rejected.

Training: at most ``docs_per_language`` documents of each language, those with the smallest hash
of doc_id, and of their text at most ``dictionary_bytes`` in all: a bounded sample of labelled
rows. Every language of the labelled rows has its dictionary, however many there are: they are built
on the executors, and the driver and each worker hold ``dictionary_bytes`` a language. Every text is
compressed whole, in pieces of ``piece_bytes``, so memory is bounded and the dictionary weighs
equally in every piece of a long text. Work grows with the number of languages; at most four blocks
of ``_BLOCK`` prepared dictionaries are held at a time.

Defined results: of a repeated doc_id the smallest text of a language is learned; a null text and a
text with no letter are ``und`` with score 0; equal sizes go to the language with more training
documents, then to the smaller name; with nothing to learn from, every text is ``und``; repeated rows are judged alike; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.text_bytes import slices, texts

UNDETERMINED = "und"
_BLOCK = 64  # dictionaries prepared together
# Letters are lower-cased first; all other ASCII characters count as one space.
_ONLY_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class LanguageModel:
    dictionaries: tuple[tuple[str, bytes], ...]  # in order of preference at equal sizes
    level: int = 6
    piece_bytes: int = 8_192


def plain_bytes(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_ONLY_LETTERS).split())


def fit(
    docs: DataFrame, lang: str = "lang", doc_id: str = "doc_id", text: str = "text",
    docs_per_language: int = 48, dictionary_bytes: int = 49_152,
) -> LanguageModel:
    """Dictionaries from the rows given (the caller leaves out what must not be learned from)."""
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{lang}`").alias("_lang"), F.col(f"`{text}`").alias("_text"),
    ).where(F.col("_lang").isNotNull() & F.col("_text").isNotNull() & F.col("_id").isNotNull())
    lang_type = rows.schema["_lang"].dataType.simpleString()
    sizes = rows.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").collect()
    by_hash = Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id")
    chosen = (
        rows.select("_id", "_lang").distinct().withColumn("_n", F.row_number().over(by_hash))
        .where(F.col("_n") <= docs_per_language).drop("_n"))
    # At most docs_per_language ids of each language: a small table for the broadcast.
    # A repeated id gives one text, the smallest, so that it takes no other id's place.
    sampled = rows.join(F.broadcast(chosen), ["_id", "_lang"]).groupBy("_id", "_lang").agg(F.min("_text").alias("_text")).select(
        "_lang", F.xxhash64("_id").alias("_hash"), F.col("_id").cast("string").alias("_id"), "_text")

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):  # of one text no more than a dictionary holds
            cut = [plain_bytes(t)[:dictionary_bytes] for t in texts(part, "_text")]
            yield pa.RecordBatch.from_arrays(
                [part.column("_lang"), part.column("_hash"), part.column("_id"), pa.array(cut, pa.binary())],
                names=["_lang", "_hash", "_id", "plain"])

    def joined(group: pa.Table) -> pa.Table:
        parts = group.sort_by([("_hash", "ascending"), ("_id", "ascending"), ("plain", "ascending")]).column("plain").to_pylist()
        share = dictionary_bytes // max(1, len(parts))
        short = sum(max(0, share - len(p)) for p in parts)  # what short documents leave to long ones
        held = b" ".join(p[:share + 2 * short // max(1, len(parts))] for p in parts)[:dictionary_bytes]
        return pa.table({"_lang": group.column("_lang")[:1], "held": pa.array([held], pa.binary())})

    built = (
        sampled.mapInArrow(plain, f"_lang {lang_type}, _hash long, _id string, plain binary")
        .groupBy("_lang").applyInArrow(joined, f"_lang {lang_type}, held binary"))
    held = {r["_lang"]: bytes(r["held"]) for r in built.collect()} if sizes else {}
    return LanguageModel(tuple((size["_lang"], held[size["_lang"]]) for size in sizes if held.get(size["_lang"])))


@lru_cache(maxsize=4)
def _compressors(model: LanguageModel, first: int) -> list:
    """Of one block of dictionaries."""
    import zstandard

    out = []
    for _, held in model.dictionaries[first:first + _BLOCK]:
        dictionary = zstandard.ZstdCompressionDict(held, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=model.level)
        out.append(zstandard.ZstdCompressor(
            level=model.level, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False))
    return out


def sizes_of(of_texts: list[str], model: LanguageModel) -> np.ndarray:
    """Compressed bytes of the whole texts under each dictionary, texts x languages."""
    cut = []
    for data in map(plain_bytes, of_texts):
        cut.append([data[i:i + model.piece_bytes] for i in range(0, len(data), model.piece_bytes)] or [b""])
    out = np.zeros((len(cut), len(model.dictionaries)))
    for first in range(0, len(model.dictionaries), _BLOCK):
        held = _compressors(model, first)
        for row, pieces in zip(out, cut):
            row[first:first + len(held)] = [sum(len(c.compress(p)) for p in pieces) for c in held]
    return out


def predict(
    docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text", min_margin: float = 0.01,
) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judged(sizes: np.ndarray) -> tuple[str, float, bool]:
        best = int(sizes.argmin())
        others = np.delete(sizes, best)
        margin = (others.min() - sizes[best]) / sizes[best] if len(others) else 1.0
        score = 1.0 / np.exp(np.clip(-0.5 * (sizes - sizes[best]), -50, 0)).sum()
        return sent.value.dictionaries[best][0], float(score), bool(margin < min_margin)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            held = texts(part, "_text")
            at = [i for i, t in enumerate(held) if any(map(str.isalpha, t))] if sent.value.dictionaries else []
            found = [(UNDETERMINED, 0.0, True)] * len(held)
            for i, sizes in zip(at, sizes_of([held[i] for i in at], sent.value)):
                found[i] = judged(sizes)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"])

    return rows.mapInArrow(judge, f"doc_id {id_type}, lang_pred string, score double, rejected boolean")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices bounded in bytes and in rows, as each row has a size per language."""
    for part in slices(batches, "_text"):
        for start in range(0, part.num_rows, 512):
            yield part.slice(start, 512)
