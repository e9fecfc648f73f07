"""Phrase collocations: frequent n-grams by mergeable Misra-Gries summaries, then exact counts.

1. Every n-gram of 1 to 4 words inside a piece of text is hashed (its language included); the leading bits
   name its hash partition. A first pass counts the occurrences (the mass) of each partition.
2. Each task sends Misra-Gries summaries of what it has gathered, one per partition, and a partition merges what it
   receives. The capacity of a partition's summaries exceeds its mass divided by the threshold, so
   all that is taken off on the way, in tasks and merges together, is below the threshold: an n-gram
   that occurs that often is always left. Two n-grams that share a hash only keep each other.
3. A second pass counts the surviving n-grams exactly, by their words and not by hash, and the rest is SQL over
   that small table: parts of each cut, the lowest-scoring cut, longer phrases, ranks.

Scale: a partition's merge streams and holds its capacity and one buffer. The survivors reach the
second pass as a bitmap of at most ``2 ** MOST_BITS`` bits (16 MB), whatever the corpus: beyond some 30 million
survivors more n-grams pass it by chance and are counted, and results stay the same. A frequent
n-gram or language collapses in the tasks, before any shuffle; ranks are taken in 64 slices per
language first.

Defined results: a null or empty text has no words; a null language is ``und`` and shares its table with
a language of that name; repeated rows count again; a text over ``CHUNK_BYTES`` is cut between pieces, which no
phrase crosses, so memory is bounded by that and the longest piece; an empty table gives an empty
table; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tripweave.llm.text_bytes import lower, mixed, raw, slices, word_ids, word_spans
from tripweave.sinks.files import store

MOST_WORDS = 4
CHUNK_BYTES = 2_000_000
SUMMARY_ENTRIES = 2_000_000  # that a task gathers before it sends summaries; more where executors are larger
MOST_BITS = 27
_KEY_BITS = 32  # of an n-gram's hash inside its partition
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_BLANK = _BREAK.copy()
_BLANK[[0x20, 0x09]] = True


@dataclass
class Chunk:
    """Words of some texts: their numbers, hashes of the n-grams of each length, and where those stand."""

    languages: list[str]
    language: np.ndarray  # of each word
    ids: np.ndarray
    spaced: np.ndarray
    offsets: np.ndarray
    starts: list[np.ndarray]  # first words of the n-grams of 1, 2, ... words
    hashes: list[np.ndarray]

    @staticmethod
    def of(data: np.ndarray, where: np.ndarray, row_languages: list[str], most_words: int) -> Chunk:
        data = lower(data)
        first, end, row = word_spans(data, where, _BLANK)
        ids, word_hash, spaced, offsets = word_ids(data, first, end)
        languages, code = np.unique(np.array(row_languages, object).astype(str), return_inverse=True)
        language_hash = np.array([xxh3_64_intdigest(g.encode()) for g in languages.tolist()], np.uint64)
        of_word = code[row]
        hashes = word_hash[ids] if len(ids) else np.zeros(0, np.uint64)
        breaks = np.cumsum(_BREAK[data], dtype=np.int32)
        goes_on = (breaks[first[1:]] == breaks[first[:-1]]) & (row[1:] == row[:-1]) if len(ids) else np.zeros(0, bool)
        starts, grams = [np.arange(len(ids))], [mixed(hashes ^ language_hash[of_word])]
        for n in range(2, most_words + 1):
            longer = starts[-1] + n - 1 < len(ids)
            at = starts[-1][longer]
            fits = goes_on[at + n - 2]
            at = at[fits]
            starts.append(at)
            grams.append(mixed(grams[-1][longer][fits] * _STEP + hashes[at + n - 1]))
        return Chunk(languages.tolist(), of_word, ids, spaced, offsets, starts, grams)


def chunks(batches: Iterator[pa.RecordBatch], most_words: int) -> Iterator[Chunk]:
    """The texts in chunks of about ``CHUNK_BYTES``; a longer text is cut behind breaks."""
    for part in slices(batches, "_text", CHUNK_BYTES):
        data, where = raw(part.column("_text"))
        languages = part.column("_lang").to_pylist()
        if part.num_rows > 1 or len(data) <= CHUNK_BYTES:
            yield Chunk.of(data, where, languages, most_words)
            continue
        breaks, at = np.flatnonzero(_BREAK[data]) + 1, 0
        while at < len(data):
            i = int(np.searchsorted(breaks, at + CHUNK_BYTES))
            stop = int(breaks[i]) if i < len(breaks) else len(data)
            yield Chunk.of(data[at:stop], np.array([0, stop - at]), languages, most_words)
            at = stop


# ---------------------------------------------------------------- Misra-Gries summaries

def capacity(mass: int, threshold: int) -> int:
    """Entries that keep what is taken off in all below the threshold: more than mass / threshold."""
    return mass // threshold + 1


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(counts, first) if len(first) else counts)


def reduced(keys: np.ndarray, counts: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A summary of at most so many entries, and what was taken off each of the ones before."""
    if len(keys) <= entries:
        return keys, counts, 0
    off = int(np.partition(counts, len(counts) - entries - 1)[len(counts) - entries - 1])  # the largest one not to fit
    left = counts > off
    return keys[left], counts[left] - off, off


class Summary:
    """The merge of a partition's summaries; ``taken`` bounds how far a count may be too low."""

    def __init__(self, entries: int):
        self.entries, self.taken = entries, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray, taken: int) -> None:
        self._waiting.append((keys, counts))
        self._held += len(keys)
        self.taken += taken
        if self._held > max(4 * self.entries, 1_000_000):
            self.merge()

    def merge(self) -> None:
        parts = [(self.keys, self.counts), *self._waiting]
        keys, counts = summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
        self.keys, self.counts, off = reduced(keys, counts, self.entries)
        self.taken += off
        self._waiting, self._held = [], 0

    def survivors(self, threshold: int) -> np.ndarray:
        self.merge()
        return self.keys[self.counts + self.taken >= threshold]


def _planes(values: np.ndarray) -> bytes:
    """Numbers of 4 bytes, byte by byte, which compresses well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def partition_bits(total_bytes: int) -> int:
    """Partitions, as a power of two: one for every 4 to 8 MB of text, up to 16,384."""
    return min(14, max(0, total_bytes // 8_000_000).bit_length())


def survivors(texts: DataFrame, threshold: int, most_words: int) -> tuple[np.ndarray, int, DataFrame]:
    """Bitmap over the leading bits of n-gram hashes that holds every frequent one, the number of those bits,
    and the words of each language (``_lang, n``)."""
    total = texts.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0
    bits = partition_bits(total)
    shift = np.uint64(64 - bits - _KEY_BITS)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masses, words = np.zeros(1 << bits, np.int64), {}
        for chunk in chunks(batches, most_words):
            for h in chunk.hashes:
                masses += np.bincount((h >> shift >> np.uint64(_KEY_BITS)).astype(np.int64), minlength=1 << bits)
            for name, n in zip(chunk.languages, np.bincount(chunk.language, minlength=len(chunk.languages)).tolist()):
                words[name] = words.get(name, 0) + n
        filled = np.flatnonzero(masses)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*filled.tolist(), *[-1] * len(words)], pa.int32()), pa.array([*[None] * len(filled), *words], pa.string()),
             pa.array([*masses[filled].tolist(), *words.values()], pa.int64())], names=["part", "_lang", "n"])

    weights = store(texts.mapInArrow(weighed, "part int, _lang string, n long").groupBy("part", "_lang").agg(F.sum("n").alias("n")), "gram-masses")
    masses = {r["part"]: r["n"] for r in weights.where(F.col("part") >= 0).collect()}  # one number per hash partition

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for chunk in chunks(batches, most_words):
            keys = np.sort(np.concatenate(chunk.hashes) >> shift)
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            waiting.append((keys[first], np.diff(np.append(first, len(keys)))))
            held += len(first)
            del chunk, keys, first
            if held > SUMMARY_ENTRIES:
                yield from sent(waiting)
                waiting, held = [], 0
        yield from sent(waiting)

    def sent(waiting: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if not waiting:
            return
        keys, counts = summed(np.concatenate([k for k, _ in waiting]), np.concatenate([c for _, c in waiting]))
        waiting.clear()
        cuts = np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(_KEY_BITS))
        rows = []
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            own = slice(cuts[part], cuts[part + 1])
            entry, count, off = reduced(keys[own].astype(np.uint32), counts[own], capacity(masses[part], threshold))
            rows.append((part, _planes(np.diff(entry, prepend=np.uint32(0))), _planes(count), off))
        for at in range(0, len(rows), 64):
            some = list(zip(*rows[at:at + 64]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some[0], pa.int32()), pa.array(some[1], pa.binary()), pa.array(some[2], pa.binary()), pa.array(some[3], pa.int64())],
                names=["part", "keys", "counts", "off"])

    # About 16 bits for every n-gram that can be frequent, at most 16 MB in all.
    map_bits = max(bits, min(MOST_BITS, max(16, (16 * sum(masses.values()) // threshold).bit_length())))
    segment = 1 << (map_bits - bits)

    def bitmap(summary: Summary) -> bytes:
        marks = np.zeros(segment, bool)
        marks[(summary.survivors(threshold).astype(np.uint64) >> np.uint64(_KEY_BITS - (map_bits - bits))).astype(np.int64)] = True
        return np.packbits(marks, bitorder="little").tobytes()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, summary = None, None

        def finished():
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bitmap(summary)], pa.binary())], names=["part", "marks"])

        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in ("part", "keys", "counts", "off")}
                if row["part"] != part:
                    if summary is not None:
                        yield finished()
                    part, summary = row["part"], Summary(capacity(masses[row["part"]], threshold))
                keys = np.cumsum(_values(row["keys"]), dtype=np.uint32)
                summary.add(keys, _values(row["counts"]).astype(np.int64), row["off"])
        if summary is not None:
            yield finished()

    marks = (
        texts.mapInArrow(summarised, "part int, keys binary, counts binary, off long")
        .repartition(max(1, 1 << bits), "part").sortWithinPartitions("part").mapInArrow(merged, "part int, marks binary"))
    held = bytearray(max(1, (segment << bits) // 8))
    for row in marks.collect():  # of fixed size in all, see MOST_BITS
        place = row["part"] * segment // 8
        held[place:place + len(row["marks"])] = row["marks"]
    return np.frombuffer(bytes(held), np.uint8), map_bits, weights.where(F.col("part") < 0).select("_lang", "n")


# ---------------------------------------------------------------- exact counts

def counted(texts: DataFrame, marks: np.ndarray, map_bits: int, most_words: int) -> DataFrame:
    """``lang, words, phrase, f``: exact occurrences of all n-grams that the bitmap lets through."""
    sent = texts.sparkSession.sparkContext.broadcast(marks)
    shift = np.uint64(64 - map_bits)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for chunk in chunks(batches, most_words):
            buffer, offsets = chunk.spaced.tobytes(), chunk.offsets
            # numbers of the (n-1)-grams that start at each word; -1: not frequent, then no longer one is
            number = chunk.language.astype(np.int64)
            frequent = np.ones(len(chunk.ids) + 1, bool)
            for n, (start, h) in enumerate(zip(chunk.starts, chunk.hashes), 1):
                place = h >> shift
                here = (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
                here &= frequent[start] & (frequent[start + 1] if n > 1 else True)
                start = start[here]
                key = number[start] << 32 | chunk.ids[start + n - 1]
                _, first, inverse, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                frequent = np.zeros(len(chunk.ids) + 1, bool)
                frequent[start] = True
                number = np.full(len(chunk.ids), -1, np.int64)
                number[start] = inverse
                at = start[first]
                phrases = [buffer[a:b] for a, b in zip(offsets[at].tolist(), (offsets[at + n] - 1).tolist())]
                names = pa.array(chunk.languages).take(pa.array(chunk.language[at]))
                for i in range(0, len(at), 50_000):
                    yield pa.RecordBatch.from_arrays(
                        [names[i:i + 50_000], pa.array([n] * len(at[i:i + 50_000]), pa.int32()),
                         pa.array(phrases[i:i + 50_000], pa.binary()).cast(pa.string()), pa.array(counts[i:i + 50_000], pa.int64())],
                        names=["lang", "words", "phrase", "f"])

    return (
        texts.mapInArrow(hits, "lang string, words int, phrase string, f long")
        .groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")))


# ---------------------------------------------------------------- phrases

def _exact(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def _span(words: Column, start: Column, count: Column) -> Column:
    return F.array_join(F.slice(words, start, count), " ")


def scored(counts: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` by the lowest-scoring cut of each candidate."""
    split = F.split("phrase", " ")
    cut = counts.where(F.col("words") > 1).withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "_k", _span(split, F.lit(1), F.col("_k")).alias("_first"),
        _span(split, F.col("_k") + 1, F.col("words") - F.col("_k")).alias("_rest"))
    part = lambda name, to: counts.select(F.col("lang"), F.col("phrase").alias(name), F.col("f").alias(to))
    both = cut.join(part("_first", "l"), ["lang", "_first"]).join(part("_rest", "r"), ["lang", "_rest"])
    score = F.expr("cast(2000000 as decimal(8,0)) * cast(a as decimal(20,0)) div cast(l + r as decimal(20,0))")
    best = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "_k", "l", "r")).alias("_best"))
    return best.select("lang", "phrase", "a", "_best.l", "_best.r", "_best.score")


def covered(counts: DataFrame, percent: int) -> DataFrame:
    """``lang, phrase``: candidates inside a longer one that is nearly as frequent."""
    words = F.split("phrase", " ")
    inner = (
        counts.where(F.col("words") > 2).select("lang", "words", F.col("f").alias("_longer"), words.alias("_words"))
        .withColumn("_count", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
        .withColumn("_start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("_count") + 1)))
        .select("lang", _span(F.col("_words"), F.col("_start"), F.col("_count")).alias("phrase"), "_longer")
        .groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer")))
    near = _exact(F.col("_longer")) * 100 >= _exact(F.col("f")) * percent
    return counts.where(F.col("words") > 1).join(inner, ["lang", "phrase"]).where(near).select("lang", "phrase")


def mine(
    docs: DataFrame, lang: str = "lang", text: str = "text", threshold: int = 30, most_words: int = MOST_WORDS,
    percent: int = 80, top: int = 2000,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language."""
    texts = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("_lang"), F.col(f"`{text}`").alias("_text"))
    marks, map_bits, words = survivors(texts, threshold, most_words)
    counts = store(counted(texts, marks, map_bits, most_words).where(F.col("f") >= threshold), "phrase-counts")
    found = scored(counts).join(covered(counts, percent), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slice_ = F.pmod(F.xxhash64("phrase"), F.lit(64))  # so that no task ranks a whole language
    in_slice = Window.partitionBy("lang", "_slice").orderBy(*order)
    first = found.withColumn("_slice", slice_).withColumn("_n", F.row_number().over(in_slice)).where(F.col("_n") <= top)
    ranks = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    best = first.withColumn("rank", ranks).where(F.col("rank") <= top)
    return best.join(words, best["lang"] == words["_lang"]).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
