"""Best-fit packing of token pieces into sequences under several capacities.

A piece is a vector: its tokens, one document, and its attention cost (the square of its tokens).
A sequence has a capacity in each. Pieces are taken from the largest; each goes to the open
sequence that it fits under every constraint and that scores best: smallest weighted norm of the
residual after placing it, or largest weighted dot product of piece and residual. A piece that
fits nowhere opens a sequence. Full pieces take a sequence each.

Scale: tokenizing is a map over the documents; only narrow rows (no text, no ids) go on. They are
dealt at random into blocks of about ``block_pieces`` pieces, each packed in one task's memory;
a block leaves one or two sequences unfilled, so blocks of 16,384 cost well under 0.1 % of the
sequences. No block depends on a document, source or length, so none is hot.

Defined results: a null text is empty and still has its closing id; repeated rows are packed as
rows of their own; an empty table gives an empty table; only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.bpe import encoder_of
from tripweave.llm.text_bytes import SLICE_BYTES, release, slices, texts
from tripweave.sinks.files import store


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds. The defaults of documents and attention never bind below tokens'."""
    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048


@dataclass(frozen=True)
class Weights:
    tokens: float = 1.0
    documents: float = 0.01
    attention: float = 0.01


def token_pieces(
    docs: DataFrame, path: str, max_tokens: int = 2048, closing_id: int = 0,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each document's ids with the closing id, cut
    into pieces of ``max_tokens`` (the last may be shorter)."""
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    id_type, step = rows.schema["doc_id"].dataType.simpleString(), 4 * max_tokens
    closing = np.array([closing_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, False)
        for part in slices(batches, "_text", SLICE_BYTES // 2):
            row, piece, length, crc = [], [], [], []
            for i, ids in enumerate(encoder.encode_batch(texts(part, "_text"))):
                ids += closing
                for number, at in enumerate(range(0, len(ids), step)):
                    held = ids[at:at + step]
                    row.append(i)
                    piece.append(number)
                    length.append(len(held) // 4)
                    crc.append(zlib.crc32(held))
            pieces = np.array(piece, np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row, pa.int32())), pa.array(pieces),
                 pa.array(pieces.astype(np.int64) * max_tokens), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
        release()

    return rows.mapInArrow(cut, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def pack_block(lengths: np.ndarray, capacity: Capacity, weights: Weights, score: str) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece of one block."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], np.float64)
    weight = np.array([weights.tokens, weights.documents, weights.attention])
    left = np.empty((1024, 3))  # residual capacities of the open sequences
    number, used = np.empty(1024, np.int64), np.empty(1024, np.int64)
    n_open = n_made = 0
    order = np.argsort(-lengths, kind="stable")
    smallest = lengths.min() if len(lengths) else 0
    for at in order.tolist():
        size = int(lengths[at])
        piece = np.array([size, 1.0, float(size) * size])
        best = -1
        if n_open:
            fits = np.flatnonzero((left[:n_open] >= piece).all(axis=1))
            if len(fits):
                rest = left[fits]
                if score == "norm":
                    value = ((((rest - piece) / full) ** 2) * weight).sum(axis=1)
                    best = int(fits[value.argmin()])
                else:
                    value = ((rest / full) * (piece / full) * weight).sum(axis=1)
                    best = int(fits[value.argmax()])
        if best < 0:
            if n_open == len(left):
                left, number, used = (np.concatenate([x, np.empty_like(x)]) for x in (left, number, used))
            best, n_open = n_open, n_open + 1
            left[best], number[best], used[best] = full, n_made, 0
            n_made += 1
        sequence[at], offset[at] = number[best], used[best]
        left[best] -= piece
        used[best] += size
        if left[best, 0] < smallest or left[best, 1] < 1:  # nothing fits any more: closed
            n_open -= 1
            left[best], number[best], used[best] = left[n_open], number[n_open], used[n_open]
    return sequence, offset


def pack(
    pieces: DataFrame, capacity: Capacity = Capacity(), weights: Weights = Weights(),
    score: str = "norm", block_pieces: int = 16_384,
) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. A piece over a capacity is an error."""
    stored = store(pieces, "pieces")
    total = stored.count()
    blocks = max(1, -(-total // block_pieces))
    dealt = stored.withColumn(
        "_block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema.fields)

    def packed(key: tuple, rows: pa.Table) -> pa.Table:
        lengths = np.asarray(rows.column("length"))
        if len(lengths) and (lengths.max() > capacity.tokens or int(lengths.max()) ** 2 > capacity.attention):
            raise ValueError("a piece exceeds the capacity of a sequence")
        rows = rows.drop_columns(["_block"])
        sequence, offset = pack_block(lengths, capacity, weights, score)
        return (rows.append_column("sequence_id", pa.array((key[0].as_py() << 32) + sequence))
                .append_column("offset", pa.array(offset)))

    return dealt.groupBy("_block").applyInArrow(packed, f"{out}, sequence_id long, offset long")
