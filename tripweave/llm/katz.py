"""Katz backoff language model: counts, backoff weights and the score of every document.

With ``r`` the training count of an n-gram and ``d`` its Good-Turing discount (counts up to 5),

    P(w | h) = d(r) r / c(h)            where the n-gram h w was seen,
               a(h) P(w | h')           where only its history h was (h' lacks h's first word),
               P(w | h')                where not even that was,

and ``a(h)`` is exactly what the discounts of h's followers left over, divided by what the lower order
gives to all other words. Words end in P(w) = d(r) r / N, and one unknown word has the rest. A history
without discounted followers is counted once more than it occurs, so that something is left for others.

1. Texts are dealt into batches of about ``BATCH_BYTES`` and written once, bucketed by batch, so that later
   steps meet them without a shuffle. A longer text is cut between words; a cut piece knows the words before it.
2. Each batch sends its distinct n-grams (64-bit hashes, sorted, packed) with their training counts to hash
   ranges. A range writes its part of the table of counts, and answers each batch with the counts of
   its n-grams; one batch of those that trained on an n-gram becomes its owner.
3. Level by level, batches send sums over the n-grams they own per history (each n-gram once in all), ranges add
   them up to the table of backoff weights and answer again.
4. With these answers each batch evaluates the recursion for all of its tokens.

Scale: n-grams are dealt by the hash of the whole n-gram and collapse in the batches, so a word or history with
a third of all tokens is one entry per batch; the driver sees eight counts per level. Two n-grams with one hash
would be counted as one (odds 1e-4 for 50 million). Tables and answers are written to the shared folder.

Defined results: a null or empty text has the end token only; a null doc_id is an ordinary one; repeated rows are
scored and counted each; without training rows the unknown word has probability 1 (score 0); a
text of any length is evaluated whole, in bounded memory; an empty table gives an empty table; other columns are
left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.text_bytes import lower, mixed, raw, slices, word_ids, word_spans
from tripweave.session import shared_folder

BATCH_BYTES = 8_000_000
RANGE_BYTES = 16_000_000
_LARGEST = 5  # counts above are not discounted
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BEGIN, _END = (mixed(np.array([n], np.uint64))[0] for n in (0xB0, 0xE0))


# ---------------------------------------------------------------- packed numbers

def _planes(values: np.ndarray) -> bytes:
    """Numbers of 8 bytes, byte by byte, which compresses well."""
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T).tobytes()


def _values(planes: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).reshape(-1).view(kind)


def _packed(ordered: np.ndarray) -> bytes:
    return _planes(np.diff(ordered, prepend=np.uint64(0)))


def _unpacked(planes: bytes) -> np.ndarray:
    return np.cumsum(_values(planes, np.uint64), dtype=np.uint64)


def _bits(marks: np.ndarray) -> bytes:
    return np.packbits(marks).tobytes()


def _marks(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


# ---------------------------------------------------------------- the model's numbers

@dataclass(frozen=True)
class Level:
    """Good-Turing discounts of one order: ``kept[r]`` of a count r up to 5, and the order's totals."""

    kept: tuple[float, ...]
    total: int
    distinct: int

    @staticmethod
    def of(n_of: list[int], total: int, distinct: int) -> Level:
        """``n_of[r]``: n-grams that were seen r times. Where the Good-Turing ratio is no discount (sparse or odd
        counts), half an occurrence is taken off."""
        most = (_LARGEST + 1) * n_of[_LARGEST + 1] / n_of[1] if n_of[1] else 1.0
        kept = [0.0]
        for r in range(1, _LARGEST + 1):
            ratio = ((r + 1) * n_of[r + 1] / (r * n_of[r]) - most) / (1 - most) if n_of[r] and most < 1 else 0.0
            kept.append(r * ratio if 0 < ratio < 1 else r - 0.5)
        return Level(tuple(kept), total, distinct)

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts <= _LARGEST, np.array(self.kept)[np.minimum(counts, _LARGEST)], counts)


@dataclass(frozen=True)
class Globals:
    levels: tuple[Level, ...]  # of orders 1, 2, ...
    train_documents: int
    left: float  # occurrences that the discounts of the words left over

    @property
    def word_total(self) -> float:
        return self.levels[0].total + (self.left == 0)

    @property
    def unknown(self) -> float:
        return (self.left or 1.0) / self.word_total if self.levels[0].total else 1.0


# ---------------------------------------------------------------- batches

_PREPARED = "batch long, row long, doc_id {id}, train boolean, text string, before binary, last boolean"


def _cut(text: str, order: int, size: int) -> Iterator[tuple[str, bytes, bool]]:
    """Pieces of a text with the hashes of the symbols before them and whether the text ends there."""
    if 4 * len(text) <= size:
        yield text, np.array([_BEGIN], np.uint64).tobytes(), True
        return
    data, at, before = np.frombuffer(text.encode(), np.uint8), 0, np.array([_BEGIN], np.uint64)
    while True:
        where = np.array([0, len(data) - at])
        first, end, _ = word_spans(data[at:], where) if len(data) - at <= size else word_spans(data[at:at + size], np.array([0, size]))
        if len(data) - at <= size:
            yield data[at:].tobytes().decode(), before.tobytes(), True
            return
        stop = at + (int(first[-1]) if len(first) else size)  # before the last word begun, which may go on
        while stop == at:  # one word longer than a piece
            size *= 2
            first, end, _ = word_spans(data[at:at + size], np.array([0, min(size, len(data) - at)]))
            stop = at + int(first[-1]) if at + size < len(data) else len(data)
        if stop == len(data):
            yield data[at:].tobytes().decode(), before.tobytes(), True
            return
        piece = data[at:stop]
        yield piece.tobytes().decode(), before.tobytes(), False
        first, end, _ = word_spans(piece, np.array([0, len(piece)]))
        if len(first):
            ids, hashes, _, _ = word_ids(lower(piece), first[1 - order:], end[1 - order:])
            before = np.concatenate([before, hashes[ids]])[1 - order:]
        at = stop


def prepare(docs: DataFrame, train: Column, order: int, doc_id: str, text: str) -> tuple[DataFrame, int]:
    """The texts in batches, written once and bucketed by batch, and their size in bytes."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(f"`{text}`").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition = TaskContext.get().partitionId()
        batch, filled, row = partition << 24, 0, partition << 33
        for part in slices(batches, "text", 2_000_000):
            table = part.to_pydict()
            out = {name: [] for name in ("batch", "row", "doc_id", "train", "text", "before", "last")}
            for key, trains, whole in zip(table["doc_id"], table["train"], table["text"]):
                for piece, before, last in _cut(whole or "", order, BATCH_BYTES):
                    if filled > BATCH_BYTES:
                        batch, filled = batch + 1, 0
                    filled += len(piece) + 16
                    for name, value in zip(out, (batch, row, key, trains, piece, before, last)):
                        out[name].append(value)
                row += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["batch"], pa.int64()), pa.array(out["row"], pa.int64()), pa.array(out["doc_id"], part.schema.field("doc_id").type),
                 pa.array(out["train"], pa.bool_()), pa.array(out["text"], pa.string()), pa.array(out["before"], pa.binary()), pa.array(out["last"], pa.bool_())],
                names=list(out))

    name = f"katz_{uuid.uuid4().hex}"
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    (rows.mapInArrow(dealt, _PREPARED.format(id=id_type)).write.bucketBy(buckets, "batch")
     .option("path", shared_folder(spark, "katz-texts")).option("compression", "zstd").saveAsTable(name))
    prepared = spark.table(name)
    return prepared, int(prepared.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)


def _symbols(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all symbols of a batch, the rows' bounds, which are tokens, and which rows train."""
    column = table.column("text").combine_chunks()
    data, where = raw(column.chunk(0) if isinstance(column, pa.ChunkedArray) else column)
    data = lower(data)
    first, end, row = word_spans(data, where)
    ids, hashes, _, _ = word_ids(data, first, end)
    n_words = np.bincount(row, minlength=table.num_rows)
    del data, first, end, row
    before = [np.frombuffer(b, np.uint64) for b in table.column("before").to_pylist()]
    last = np.array(table.column("last").to_pylist(), bool)
    n_before = np.array([len(b) for b in before])
    bounds = np.concatenate([[0], np.cumsum(n_before + n_words + last)])
    is_token = np.ones(bounds[-1], bool)
    for n in range(int(n_before.max())):
        is_token[bounds[:-1][n_before > n] + n] = False
    is_end = np.zeros(bounds[-1], bool)
    is_end[bounds[1:][last] - 1] = True
    symbols = np.empty(bounds[-1], np.uint64)
    symbols[~is_token] = np.concatenate(before)
    if len(ids):
        symbols[is_token & ~is_end] = hashes[ids]
    symbols[is_end] = _END
    return symbols, bounds, is_token, np.array(table.column("train").to_pylist(), bool)


class Tokens:
    """All symbols of a batch: what stands before each text, its words and its end."""

    def __init__(self, table: pa.Table, order: int):
        symbols, self.bounds, self.is_token, train = _symbols(table)
        self.row = np.repeat(np.arange(table.num_rows, dtype=np.int32), np.diff(self.bounds))
        place = np.arange(len(symbols), dtype=np.int32) - self.bounds[:-1].astype(np.int32)[self.row]
        self.trains = self.is_token & train[self.row]
        self.is_begin = symbols == _BEGIN
        # the n-grams of each order: the symbol each ends at, hash, number among the distinct hashes
        self.at, self.distinct, self.number, self.one = [], [], [], []
        key, usable = symbols, np.ones(len(symbols), bool)
        self.keys = []
        for n in range(1, order + 1):
            if n > 1:
                usable = usable & (place >= n - 1)
                key = mixed(np.concatenate([[np.uint64(0)], key[:-1]]) * _STEP + symbols)
            self.keys.append(key)
            at = np.flatnonzero(usable).astype(np.int32)
            distinct, one, number = np.unique(key[at], return_index=True, return_inverse=True)
            self.at.append(at)
            self.distinct.append(distinct)
            self.number.append(number.astype(np.int32))
            self.one.append(one.astype(np.int32))

    def train_counts(self, level: int) -> np.ndarray:
        at = self.at[level]
        return np.bincount(self.number[level], weights=self.trains[at], minlength=len(self.distinct[level])).astype(np.int64)


class Evaluation:
    """Tokens with the answers of the ranges: counts of all orders, backoff weights of some."""

    def __init__(self, tokens: Tokens, answers: pa.Table, model: Globals):
        self.tokens, self.model, order = tokens, model, len(model.levels)
        answers = answers.sort_by([("kind", "ascending"), ("level", "ascending"), ("range", "ascending")])
        columns = {c: answers.column(c).to_pylist() for c in ("kind", "level", "counts", "marks", "size")}
        chosen = lambda kind, level: [i for i, (k, v) in enumerate(zip(columns["kind"], columns["level"])) if (k, v) == (kind, level)]
        joined = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.counts, self.owned, self.weights, self.raised = [], [], [], []
        size = len(tokens.row)
        for level in range(order):
            rows = chosen("grams", level)
            held = joined([_values(columns["counts"][i], np.int64) for i in rows], np.int64)
            self.owned.append(joined([_marks(columns["marks"][i], columns["size"][i]) for i in rows], bool))
            of = np.zeros(size, np.int64)
            of[tokens.at[level]] = held[tokens.number[level]]
            self.counts.append(of)
            rows = chosen("histories", level)
            self.weights.append(joined([_values(columns["counts"][i], np.float64) for i in rows], np.float64))
            self.raised.append(joined([_marks(columns["marks"][i], columns["size"][i]) for i in rows], bool))

    def lacking(self, level: int) -> np.ndarray:
        """The distinct histories after which a token of this batch was not seen, so that it needs their weight."""
        at, key, seen, distinct = self.histories(level)
        marks = np.zeros(len(distinct), bool)
        marks[np.searchsorted(distinct, key[(seen > 0) & (self.counts[level][at] == 0)])] = True
        return marks

    def histories(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the tokens that an n-gram of this level ends at: where, the history's hash, its training count, and
        the distinct hashes of those that trained."""
        t = self.tokens
        at = t.at[level][t.is_token[t.at[level]]]
        seen = self.counts[level - 1][at - 1]
        if level == 1:
            seen = np.where(t.is_begin[at - 1], self.model.train_documents, seen)
        key = t.keys[level - 1][at - 1]
        return at, key, seen, np.unique(key[seen > 0])

    def probabilities(self, level: int) -> np.ndarray:
        """Of each token by n-grams of up to this level."""
        model, counts = self.model, self.counts[0]
        p = np.where(counts > 0, model.levels[0].discounted(counts) / max(model.word_total, 1), model.unknown)
        for n in range(1, level + 1):
            at, key, seen, distinct = self.histories(n)
            counts = self.counts[n][at]
            known = seen > 0
            place = np.searchsorted(distinct, key[known])
            weights = np.zeros(len(distinct))
            weights[self.lacking(n)] = self.weights[n]
            weight, total = np.ones(len(at)), seen.astype(float)
            weight[known] = weights[place]
            total[known] += self.raised[n][place]
            of = model.levels[n].discounted(counts) / np.maximum(total, 1)
            p[at] = np.where(counts > 0, of, weight * p[at])
        return p

    def sums(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per distinct history: what the lower order gives to its followers, what their discounts left, and
        their count, each over the n-grams that this batch owns."""
        t = self.tokens
        _, _, _, distinct = self.histories(level)
        ends = t.at[level][t.one[level][self.owned[level]]]
        counts = self.counts[level][ends]
        place = np.searchsorted(distinct, t.keys[level - 1][ends - 1])
        added = lambda values: np.bincount(place, weights=values, minlength=len(distinct))
        lower_order = self.probabilities(level - 1)[ends]
        return distinct, added(lower_order), added(counts - self.model.levels[level].discounted(counts)), added(counts)


# ---------------------------------------------------------------- ranges

_ANSWER = "kind string, level int, range int, batch long, size int, counts binary, marks binary"
_TABLE = ", keys binary, total long, n_of array<long>, spare double"
_LIST = "level int, range int, batch long, keys binary, counts binary, given binary, spare binary, marks binary"


def _ranges(ordered: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    cuts = [0, *(np.searchsorted(ordered, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []), len(ordered)]
    return ((i, slice(int(cuts[i]), int(cuts[i + 1]))) for i in range(1 << bits) if cuts[i + 1] > cuts[i])


def _frame(rows: list[dict], ddl: str) -> pa.Table:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "array<long>": pa.list_(pa.int64())}
    fields = [(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")]
    return pa.table({name: pa.array([r.get(name) for r in rows], kind) for name, kind in fields})


def _met(lists: pa.Table) -> tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray]:
    """The lists of a range: batches, bounds of each list, distinct hashes, and the place of every entry among them."""
    parts = [_unpacked(p) for p in lists.column("keys").to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    distinct, place = np.unique(np.concatenate(parts), return_inverse=True)
    return lists.column("batch").to_pylist(), bounds, distinct, place


def _count_range(lists: pa.Table) -> pa.Table:
    """A range's part of the table of counts, and the answers to the batches."""
    lists = lists.sort_by("batch")
    level, number = lists.column("level")[0].as_py(), lists.column("range")[0].as_py()
    batches, bounds, distinct, place = _met(lists)
    trained = np.concatenate([_values(c, np.int64) for c in lists.column("counts").to_pylist()])
    counts = np.zeros(len(distinct), np.int64)
    np.add.at(counts, place, trained)
    owner = np.zeros(len(place), bool)
    trains = np.flatnonzero(trained)
    owner[trains[np.unique(place[trains], return_index=True)[1]]] = True
    seen = counts > 0
    n_of = np.bincount(np.minimum(counts, _LARGEST + 2), minlength=_LARGEST + 3).tolist()
    rows = [{"kind": "table", "level": level, "range": number, "size": int(seen.sum()), "keys": _packed(distinct[seen]),
             "counts": _planes(counts[seen]), "total": int(counts.sum()), "n_of": n_of}]
    for batch, a, b in zip(batches, bounds, bounds[1:]):
        rows.append({"kind": "grams", "level": level, "range": number, "batch": batch, "size": int(b - a),
                     "counts": _planes(counts[place[a:b]]), "marks": _bits(owner[a:b])})
    return _frame(rows, _ANSWER + _TABLE)


def _weigh_range(lists: pa.Table) -> pa.Table:
    """A range's part of the table of backoff weights, and the answers to the batches."""
    lists = lists.sort_by("batch")
    level, number = lists.column("level")[0].as_py(), lists.column("range")[0].as_py()
    batches, bounds, distinct, place = _met(lists)
    given, spare, count = (
        np.bincount(place, weights=np.concatenate([_values(c, np.float64) for c in lists.column(name).to_pylist()]), minlength=len(distinct))
        for name in ("given", "spare", "counts"))
    raised = spare <= 0
    weight = np.where(raised, 1.0, spare) / (count + raised) / (1.0 - given)
    rows = [{"kind": "table", "level": level, "range": number, "size": len(distinct), "keys": _packed(distinct), "counts": _planes(weight), "marks": _bits(raised)}]
    for batch, a, b, lacking in zip(batches, bounds, bounds[1:], lists.column("marks").to_pylist()):
        own = place[a:b]
        rows.append({"kind": "histories", "level": level, "range": number, "batch": batch, "size": int(b - a),
                     "counts": _planes(weight[own[_marks(lacking, b - a)]]), "marks": _bits(raised[own])})
    return _frame(rows, _ANSWER + _TABLE)


def _kept(rows: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder, partitioned by kind: tables apart from answers."""
    path = shared_folder(rows.sparkSession, purpose)
    rows.write.partitionBy("kind", "level").option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _totals(counts: DataFrame, order: int) -> Globals:
    """Counts of counts, totals and distinct n-grams of each order: a few numbers."""
    tables = counts.where(F.col("kind") == "table").groupBy("level").agg(
        F.sum("total").alias("total"), F.sum("size").alias("size"), *[F.sum(F.col("n_of")[r]).alias(f"n{r}") for r in range(_LARGEST + 2)])
    found = {r["level"]: r for r in tables.collect()}
    levels = []
    for level in range(order):
        r = found.get(level)
        levels.append(Level.of([r[f"n{i}"] for i in range(_LARGEST + 2)], r["total"], r["size"]) if r else Level.of([0] * (_LARGEST + 2), 0, 0))
    words = found.get(0)
    left = sum(words[f"n{r}"] * (r - levels[0].kept[r]) for r in range(1, _LARGEST + 1)) if words else 0.0
    return Globals(tuple(levels), 0, left)


# ---------------------------------------------------------------- the whole

def score(docs: DataFrame, train: Column, order: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, train, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    The model learns from the rows where ``train`` holds. ``base_score`` is the word model that adds 0.1 to all
    counts; ``score`` the log10 probability by n-grams of up to ``order`` words.
    """
    spark = docs.sparkSession
    documents = int(docs.where(F.coalesce(train, F.lit(False))).count())
    prepared, size = prepare(docs, train, order, doc_id, text)
    bits = max(0, size // RANGE_BYTES).bit_length()

    def listed(batch: pa.Table) -> pa.Table:
        tokens, rows = Tokens(batch, order), []
        number = batch.column("batch")[0].as_py()
        for level in range(order):
            counts, distinct = tokens.train_counts(level), tokens.distinct[level]
            for i, own in _ranges(distinct, bits):
                rows.append({"level": level, "range": i, "batch": number, "keys": _packed(distinct[own]), "counts": _planes(counts[own])})
        return _frame(rows, _LIST)

    counts = _kept(
        prepared.groupBy("batch").applyInArrow(listed, _LIST).groupBy("level", "range").applyInArrow(_count_range, _ANSWER + _TABLE), "katz-counts")
    found = _totals(counts, order)
    model = Globals(found.levels, documents, found.left)
    answer = [f.split()[0] for f in _ANSWER.split(", ")]
    answers = counts.where(F.col("kind") == "grams").select(*answer)

    def summed(level: int):
        def of(batch: pa.Table, replies: pa.Table) -> pa.Table:
            held = Evaluation(Tokens(batch, order), replies, model)
            distinct, given, spare, total = held.sums(level)
            lacking = held.lacking(level)
            number = batch.column("batch")[0].as_py()
            return _frame([
                {"level": level, "range": i, "batch": number, "keys": _packed(distinct[own]), "given": _planes(given[own]),
                 "spare": _planes(spare[own]), "counts": _planes(total[own]), "marks": _bits(lacking[own])} for i, own in _ranges(distinct, bits)], _LIST)
        return of

    for level in range(1, order):
        lists = prepared.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(summed(level), _LIST)
        weights = _kept(lists.groupBy("level", "range").applyInArrow(_weigh_range, _ANSWER + _TABLE), f"katz-weights-{level}")
        answers = answers.unionByName(weights.where(F.col("kind") == "histories").select(*answer))

    id_field = prepared.schema["doc_id"]

    def evaluated(batch: pa.Table, replies: pa.Table) -> pa.Table:
        tokens = Tokens(batch, order)
        held = Evaluation(tokens, replies, model)
        total, distinct = model.levels[0].total, model.levels[0].distinct
        row, is_token = tokens.row[tokens.is_token], tokens.is_token
        seen = held.counts[0][is_token]
        base = np.log10((seen + 0.1) / (total + 0.1 * (distinct + 1)))
        logs = np.log10(held.probabilities(order - 1)[is_token])
        added = lambda values: np.bincount(row, weights=values, minlength=batch.num_rows)
        return pa.table({
            "row": batch.column("row"), "doc_id": batch.column("doc_id"), "train": batch.column("train"),
            "n_tokens": pa.array(np.bincount(row, minlength=batch.num_rows), pa.int64()),
            "n_known": pa.array(added(seen > 0).astype(np.int64), pa.int64()),
            "base_score": pa.array(added(base)), "score": pa.array(added(logs))})

    scored = prepared.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        evaluated, f"row long, doc_id {id_field.dataType.simpleString()}, train boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("train").alias("train"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.lit(model.levels[0].total).cast("long").alias("train_tokens"), F.sum("base_score").alias("base_score"), F.sum("score").alias("score")).drop("row")
