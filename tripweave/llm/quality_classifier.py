"""Quality by nearest-neighbour voting in a latent semantic space.

A text's terms are its hashed byte pairs, the shapes of its words (first and last character
class, length) and how its words and lines repeat. Term weights (log counts times inverse document
frequency) are projected by a truncated singular value decomposition, fitted on a bounded labelled
sample, to unit vectors. The sample's vectors and labels are broadcast; every document is compared
to all of them by exact cosine products, block by block, and the labels of the nearest
neighbours vote with their similarity as weight.

Bounds: at most ``max_labelled`` labelled rows, those with the smallest hash of doc_id and up to
half of them per label, are collected to the driver and broadcast (64 numbers each); of a repeated
doc_id the smallest text is taken. Scoring is
a map over the documents with bounded slices; no shuffle.

Defined results: null and empty texts have no terms and get the share of label 1 among the
labelled rows met (0.5 without any); without labels every score is 0.5; ties between neighbours go
to the earlier labelled row; repeated rows score alike; an empty table gives an empty table; other
columns, whatever their names, pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.text_bytes import SLICE_BYTES, raw, release, slices, word_hashes, word_spans

PAIR_BUCKETS = 4096
_SHAPES = 10 * 10 * 16
_REPEATS = 16
N_TERMS = PAIR_BUCKETS + _SHAPES + _REPEATS
_PAIR_WEIGHT, _SHAPE_WEIGHT, _REPEAT_WEIGHT = 1.0, 1.0, 3.0

# Character classes of words: lower, upper, digit, non-ASCII, and groups of signs.
_CLASS = np.full(256, 9, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 3
for _group, _signs in ((4, b".,;:"), (5, b"!?"), (6, b"#*$%&"), (7, b"|<>"), (8, b"\"'()-")):
    _CLASS[np.frombuffer(_signs, np.uint8)] = _group


@dataclass(frozen=True)
class QualityModel:
    projection: np.ndarray  # terms x dimensions, inverse document frequencies included
    vectors: np.ndarray  # labelled rows x dimensions, unit length
    labels: np.ndarray
    neighbours: int = 15
    sharpness: float = 4.0

    @property
    def prior(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5


def term_counts(column: pa.Array) -> np.ndarray:
    """Weighted log counts of the terms of each row, rows x terms."""
    data, where = raw(column)
    n = len(where) - 1
    out = np.zeros((n, N_TERMS), np.float32)
    if not len(data):
        return out
    owner = np.repeat(np.arange(n), np.diff(where))
    pair = (data[:-1].astype(np.uint32) * 256 + data[1:]) * np.uint32(2654435761)
    pair = (pair >> np.uint32(20)).astype(np.int64)
    same = owner[:-1] == owner[1:]
    starts, ends, row = word_spans(data, where)
    hashes = word_hashes(data, starts, ends)
    shape = (_CLASS[data[starts]].astype(np.int64) * 10 + _CLASS[data[ends - 1]]) * 16 + np.minimum(ends - starts, 15)
    for r, (low, high) in enumerate(zip(where[:-1], where[1:])):
        if high - low > 1:
            inside = slice(low, high - 1)
            out[r, :PAIR_BUCKETS] = np.bincount(pair[inside][same[inside]], minlength=PAIR_BUCKETS)
    bounds = np.searchsorted(row, np.arange(n + 1))
    for r in range(n):
        first, last = bounds[r], bounds[r + 1]
        if last == first:
            continue
        out[r, PAIR_BUCKETS:PAIR_BUCKETS + _SHAPES] = np.bincount(shape[first:last], minlength=_SHAPES)
        words = hashes[first:last]
        follows = float((words[1:] == words[:-1]).sum()) / len(words)
        distinct = len(np.unique(words)) / len(words)
        capitals = float((_CLASS[data[where[r]:where[r + 1]]] == 1).mean())
        at = PAIR_BUCKETS + _SHAPES
        out[r, at + min(4, int(follows * 5))] = 20
        out[r, at + 5 + min(4, int((1 - distinct) * 5 * min(1.0, 200 / len(words))))] = 20
        out[r, at + 10 + min(4, int(capitals * 5))] = 20
    np.log1p(out, out=out)
    out[:, PAIR_BUCKETS:PAIR_BUCKETS + _SHAPES] *= _SHAPE_WEIGHT
    out[:, PAIR_BUCKETS + _SHAPES:] *= _REPEAT_WEIGHT
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def fit_rows(counts: np.ndarray, labels: list[int], dimensions: int = 64) -> QualityModel:
    """The decomposition and the labelled vectors, from the terms of the labelled rows."""
    if not len(counts):
        return QualityModel(np.zeros((N_TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 0.1
    weighted = _unit(counts * idf.astype(np.float32))
    # Left to right: a randomised decomposition with two power rounds, seeded.
    random = np.random.default_rng(3)
    wanted = min(dimensions, *weighted.shape)
    basis = np.linalg.qr(weighted @ random.standard_normal((weighted.shape[1], wanted + 16)).astype(np.float32))[0]
    for _ in range(2):
        basis = np.linalg.qr(weighted @ (weighted.T @ basis))[0]
    _, _, terms = np.linalg.svd(basis.T @ weighted, full_matrices=False)
    projection = (terms[:wanted].T * idf[:, None]).astype(np.float32)
    return QualityModel(projection, _unit(counts @ projection), np.array(labels, np.float64))


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    max_labelled: int = 3_000,
) -> QualityModel:
    """Model of a bounded sample of the labelled rows given."""
    known = labels.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").alias("_label")).where(
        F.col("_id").isNotNull() & F.col("_label").isin(0, 1)).distinct()
    parts = [known.where(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(max_labelled // 2) for value in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    # The chosen rows number max_labelled at most, a proven bound for the broadcast and the collect:
    # of a repeated id one text is taken, so that its copies take no other id's place.
    # Terms are counted by the executors; the driver gets at most N_TERMS numbers a row, whatever its text's length.
    texts = rows.join(F.broadcast(chosen), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text")).select(
        F.xxhash64("_id").alias("_hash"), F.col("_id").cast("string").alias("_name"), F.col("_label").cast("int").alias("_label"), "_text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, "_text"):
                terms = term_counts(part.column("_text"))
                found = [np.flatnonzero(row) for row in terms]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("_hash", "_name", "_label")),
                     pa.array([f.astype(np.uint16).tobytes() for f in found], pa.binary()),
                     pa.array([row[f].tobytes() for row, f in zip(terms, found)], pa.binary())],
                    names=["_hash", "_name", "_label", "places", "weights"])
        release()

    sample = texts.mapInArrow(counted, "_hash long, _name string, _label int, places binary, weights binary").collect()
    sample.sort(key=lambda r: (r["_hash"], r["_name"], r["_label"]))
    counts = np.zeros((len(sample), N_TERMS), np.float32)
    for row, r in zip(counts, sample):
        row[np.frombuffer(r["places"], np.uint16)] = np.frombuffer(r["weights"], np.float32)
    return fit_rows(counts, [r["_label"] for r in sample])


def scores_of(column: pa.Array, model: QualityModel) -> np.ndarray:
    counts = term_counts(column)
    out = np.full(len(column), model.prior)
    if not len(model.labels):
        return out
    vectors = _unit(counts @ model.projection)
    k = min(model.neighbours, len(model.labels))
    for at in range(0, len(vectors), 512):
        cosine = vectors[at:at + 512] @ model.vectors.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** model.sharpness
        total = weight.sum(axis=1)
        vote = (weight * model.labels[near]).sum(axis=1)
        out[at:at + 512] = np.where(total > 0, vote / np.where(total > 0, total, 1), model.prior)
    out[~counts.any(axis=1)] = model.prior
    return out


def score_column(docs: DataFrame, model: QualityModel, text: str = "text") -> Column:
    """The score (0 to 1) of each row as a column; only the text is handed to Python."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        found = [scores_of(part.column("text"), sent.value) for part in _parts(batch, "text")]
        release()
        return pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())

    return scored(F.col(f"`{text}`"))


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices bounded in bytes and in rows, as each row has a dense term vector."""
    for part in slices([batch], column, SLICE_BYTES // 4):
        for start in range(0, part.num_rows, 512):
            yield part.slice(start, 512)


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows whose score reaches the threshold, with their own columns."""
    return docs.where(score_column(docs, model, text) >= threshold)
