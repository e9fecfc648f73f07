"""N-gram Jaccard join by T-occurrence search, and the groups of documents that it links.

A document's set is its distinct 5-word shingles (64-bit hashes). Two sets link when
``100 * intersection >= 75 * union``, so a partner of a set of ``n`` shares at least
``T = ceil(3 n / 4)`` shingles with it.

1. Documents with the same set form a class; from here on a class counts once.
2. The inverted index over all shingles is dealt out by ranges of hash: each task of the map side
   sends one packed list of (hash, row) per range. A range knows how many rows hold each
   shingle and returns only the shared ones. A class with fewer than T shared shingles can have
   no partner and leaves, which drops most of a corpus.
3. Shared shingles are put in the order of how many rows hold them, rarest first. Partners share
   one of the first ``shared - T + 1`` of that order, so classes joined by such a shingle, in
   the transitive sense, hold all links; frequent passages come last and join nothing by themselves.
4. Inside such a group the T-occurrence search runs: for a query set, its short inverted lists
   are merged and counted, documents that the L longest lists could still lift to T are
   probed in those by binary search (DivideSkip), and those reaching the required overlap link.
   Found partners become queries in turn, and only classes not yet reached are searched, so a group of near
   copies costs about one query, not all its pairs.
5. A group over ``group_postings`` is never held in one task: its classes are compared with a
   few pivots first. Those outside the largest set so connected (the rest) are searched among the holders of
   each of their rare shingles or, where that would send more, against the group block by block.

All steps are exact for sets of hashes; no cap, sample or prefix drops a link. Hash collisions could
matter only inside one pair (odds about 1e-14 for a pair of pages).

Defined results: a text without words (null, empty) has an empty set and is linked with nothing;
1 to 4 words form one shingle; repeated rows are copies of each other; a null doc_id is carried
and never names a component unless no other is there; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tripweave.llm import row_keys
from tripweave.llm.connected import components
from tripweave.llm.text_bytes import release, shingle_sets, slices
from tripweave.sinks.files import store

_BATCH_BYTES = 8_000_000
GROUP_POSTINGS = 1_000_000
_SKIP_WEIGHT = 0.0085  # DivideSkip's balance between merging and probing


def needed(n: int) -> int:
    """Shingles that any partner of a set of ``n`` shares with it, at least."""
    return (3 * n + 3) // 4


def links(overlap, n, m):
    return 100 * overlap >= 75 * (n + m - overlap)


def memberships(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, class`` (128-bit digest of the set; null for the empty set)."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            flat, where = shingle_sets(part.column("_text"))
            sizes = np.diff(where)
            digests = [xxh3_128_digest(flat[a:b].tobytes()) if b > a else None for a, b in zip(where[:-1], where[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())],
                names=["doc_id", "n_shingles", "class"])
        release()

    return rows.mapInArrow(described, f"doc_id {id_type}, n_shingles long, class binary")


# ---------------------------------------------------------------- shared shingles

def _packed(ordered: np.ndarray) -> bytes:
    """Sorted hashes as byte planes of their differences, which compress well."""
    steps = np.diff(ordered, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(planes: bytes) -> np.ndarray:
    bytes_of = np.frombuffer(planes, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(bytes_of.T).view(np.uint64).reshape(-1), dtype=np.uint64)


def _row_planes(rows: np.ndarray) -> bytes:
    return np.ascontiguousarray(rows.view(np.uint8).reshape(-1, 4).T).tobytes()


def _row_values(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view(np.uint32).reshape(-1)


def range_count(total_bytes: int) -> int:
    """Hash ranges, a power of two: each gets the shingles of 2 to 64 MB of text."""
    share = min(max(total_bytes // 256, 2 << 20), 64 << 20)
    return 1 << max(0, -(-total_bytes // share) - 1).bit_length()


def shared_shingles(docs: DataFrame, text: str = "text") -> DataFrame:
    """``class, n, hashes``: the classes that may have partners with their shared shingles
    (64-bit, rarest first). A class may occur several times."""
    rows = docs.select(F.col(f"`{text}`").alias("_text"))
    total = rows.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0
    bits = range_count(total).bit_length() - 1

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        batch_id = TaskContext.get().partitionId() << 24
        for part in slices(batches, "_text", _BATCH_BYTES):
            batch_id += 1
            flat, where = shingle_sets(part.column("_text"))
            known, pieces, sizes = {}, [], []
            for a, b in zip(where[:-1], where[1:]):
                digest = xxh3_128_digest(flat[a:b].tobytes()) if b > a else None
                if digest is not None and digest not in known:
                    known[digest] = len(known)
                    pieces.append(flat[a:b])
                    sizes.append(int(b - a))
            if not known:
                continue
            names = ["range", "batch", "hashes", "rows", "classes"]
            table = b"".join(known) + np.array(sizes, np.int64).tobytes()
            hashes = np.concatenate(pieces)
            owners = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
            order = np.argsort(hashes, kind="stable")
            hashes, owners = hashes[order], owners[order]
            edges = np.searchsorted(hashes, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
            cuts = [0, *edges, len(hashes)]
            filled = [i for i in range(1 << bits) if cuts[i + 1] > cuts[i]]
            # The batch's own classes travel under a key of their own, past the ranges.
            yield pa.RecordBatch.from_arrays(
                [pa.array([-batch_id, *filled], pa.int64()), pa.array([batch_id] * (len(filled) + 1), pa.int64()),
                 pa.array([None, *(_packed(hashes[cuts[i]:cuts[i + 1]]) for i in filled)], pa.binary()),
                 pa.array([None, *(_row_planes(owners[cuts[i]:cuts[i + 1]]) for i in filled)], pa.binary()),
                 pa.array([table, *[None] * len(filled)], pa.binary())], names=names)
        release()

    def counted(lists: pa.Table) -> pa.Table:
        if lists.column("range")[0].as_py() < 0:
            return pa.table({name: lists.column(name) for name in ("batch", "hashes", "rows", "classes")}
                            | {"held": pa.nulls(len(lists), pa.binary())})
        lists = lists.sort_by("batch")
        parts = [_unpacked(p) for p in lists.column("hashes").to_pylist()]
        _, place, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        held = np.minimum(times, 255).astype(np.uint8)[place]
        out, at = {name: [] for name in ("batch", "hashes", "rows", "classes", "held")}, 0
        for batch, part, row in zip(lists.column("batch").to_pylist(), parts, lists.column("rows").to_pylist()):
            own = held[at:at + len(part)]
            at += len(part)
            shared = own > 1
            if shared.any():
                out["batch"].append(batch)
                out["hashes"].append(_packed(part[shared]))
                out["rows"].append(_row_planes(_row_values(row)[shared]))
                out["classes"].append(None)
                out["held"].append(own[shared].tobytes())
        return pa.table({name: pa.array(values, pa.int64() if name == "batch" else pa.binary()) for name, values in out.items()})

    def gathered(key: tuple, lists: pa.Table) -> pa.Table:
        table = next((c for c in lists.column("classes").to_pylist() if c is not None), b"")
        n_classes = len(table) // 24
        digests = [table[16 * i:16 * i + 16] for i in range(n_classes)]
        sizes = np.frombuffer(table[16 * n_classes:], np.int64)
        found = [(h, r, k) for h, r, k in zip(*(lists.column(c).to_pylist() for c in ("hashes", "rows", "held"))) if h is not None]
        out = {"class": [], "n": [], "hashes": []}
        if found:
            hashes = np.concatenate([_unpacked(h) for h, _, _ in found])
            owner = np.concatenate([_row_values(r) for _, r, _ in found])
            held = np.concatenate([np.frombuffer(k, np.uint8) for _, _, k in found])
            order = np.lexsort((hashes, held, owner))
            hashes, owner = hashes[order], owner[order]
            cuts = np.searchsorted(owner, np.arange(n_classes + 1))
            for i in range(n_classes):
                if cuts[i + 1] - cuts[i] >= needed(int(sizes[i])):
                    out["class"].append(digests[i])
                    out["n"].append(int(sizes[i]))
                    out["hashes"].append(hashes[cuts[i]:cuts[i + 1]].tobytes())
        return pa.table({"class": pa.array(out["class"], pa.binary()), "n": pa.array(out["n"], pa.int64()),
                         "hashes": pa.array(out["hashes"], pa.binary())})

    return (
        rows.mapInArrow(listed, "range long, batch long, hashes binary, rows binary, classes binary")
        .groupBy("range").applyInArrow(counted, "batch long, hashes binary, rows binary, classes binary, held binary")
        .groupBy("batch").applyInArrow(gathered, "class binary, n long, hashes binary"))


def rare_shingles(sets: DataFrame, *carried: str) -> DataFrame:
    """``hash, class`` and the ``carried`` columns: the rarest shingles of each class, one of which any partner shares."""
    names = ["class", *carried]
    types = ", ".join(f"{c} {sets.schema[c].dataType.simpleString()}" for c in names)

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists = [np.frombuffer(h, np.int64) for h in part.column("hashes").to_pylist()]
                lists = [h[:len(h) - needed(n) + 1] for h, n in zip(lists, part.column("n").to_pylist())]
                owner = pa.array(np.repeat(np.arange(len(lists)), [len(h) for h in lists]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64)),
                     *(part.column(c).take(owner) for c in names)], names=["hash", *names])

    return sets.select("n", "hashes", *names).mapInArrow(firsts, f"hash long, {types}")


def candidate_groups(sets: DataFrame) -> DataFrame:
    """``node, root``: classes that share one of their rarest shingles, in the transitive sense."""
    first = rare_shingles(sets)
    least = (
        first.groupBy("hash").agg(F.min("class").alias("b"), F.max("class").alias("_most"))
        .where(F.col("b") < F.col("_most")).drop("_most"))
    edges = first.join(least, "hash").where(F.col("class") != F.col("b")).select(F.col("class").alias("a"), "b").distinct()
    return components(edges)


# ---------------------------------------------------------------- T-occurrence search

class InvertedIndex:
    """Lists of the documents that hold each shingle, over the documents still to be found."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, alive: np.ndarray):
        documents = np.flatnonzero(alive)
        lengths = [len(sets[d]) for d in documents]
        flat = np.concatenate([sets[d] for d in documents]) if len(documents) else np.zeros(0, np.uint64)
        owner = np.repeat(documents, lengths)
        order = np.argsort(flat, kind="stable")
        self.shingles, first = np.unique(flat[order], return_index=True)
        self.bounds = np.append(first, len(flat))
        self.documents, self.sizes = owner[order], sizes

    def search(self, query: np.ndarray, n: int, alive: np.ndarray) -> np.ndarray:
        """Living documents that link with the query set (DivideSkip)."""
        if not len(self.shingles):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.shingles, query), len(self.shingles) - 1)
        known = at[self.shingles[at] == query]
        threshold = needed(n)
        if len(known) < threshold:
            return np.zeros(0, np.int64)
        lengths = self.bounds[known + 1] - self.bounds[known]
        order = np.argsort(lengths, kind="stable")
        known, lengths = known[order], lengths[order]
        n_long = min(threshold - 1, int(threshold / (_SKIP_WEIGHT * np.log2(max(2, int(lengths[-1]))) + 1)))
        split = len(known) - n_long
        short = [self.documents[self.bounds[k]:self.bounds[k + 1]] for k in known[:split]]
        merged = np.sort(np.concatenate(short), kind="stable")  # merges the sorted runs
        document, count = np.unique(merged[alive[merged]], return_counts=True)
        sizes = self.sizes[document]
        keep = (count >= threshold - n_long) & (4 * sizes >= 3 * n) & (4 * n >= 3 * sizes)
        document, count, sizes = document[keep], count[keep], sizes[keep]
        for left, k in zip(range(n_long - 1, -1, -1), known[split:]):
            if not len(document):
                break
            held = self.documents[self.bounds[k]:self.bounds[k + 1]]
            place = np.searchsorted(held, document)
            count = count + (held[np.minimum(place, len(held) - 1)] == document)
            if left % 16 == 0:  # what the lists left cannot lift to its need leaves
                possible = 7 * (count + left) >= 3 * (sizes + n)
                document, count, sizes = document[possible], count[possible], sizes[possible]
        return document[links(count, sizes, n)]


def connect(sets: list[np.ndarray], sizes: np.ndarray, queries: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect what the search connects: a spanning forest.

    ``queries`` (bool per document): only links with one of these are looked for; by
    default all.
    """
    alive = np.ones(len(sets), bool)
    index, indexed, found = InvertedIndex(sets, sizes, alive), len(sets), []
    if queries is not None:  # each query against all, no transitive steps needed
        for q in np.flatnonzero(queries):
            alive[q] = False  # a pair of queries is looked at once
            found += [(int(q), int(d)) for d in index.search(sets[q], int(sizes[q]), alive)]
        return found
    for first in np.argsort(-np.array([len(s) for s in sets]), kind="stable").tolist():
        if not alive[first]:
            continue
        alive[first] = False
        waiting = [first]
        while waiting:
            q = waiting.pop()
            near = index.search(sets[q], int(sizes[q]), alive)
            alive[near] = False
            waiting += near.tolist()
            found += [(q, int(d)) for d in near]
            left = int(alive.sum())
            if not left:
                return found
            if left * 2 < indexed:
                index, indexed = InvertedIndex(sets, sizes, alive), left
    return found


def _links_table(keys: list[bytes], found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([keys[i] for i, _ in found], pa.binary()), "b": pa.array([keys[j] for _, j in found], pa.binary())})


def _loaded(group: pa.Table) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    return (group.column("class").to_pylist(), [np.frombuffer(h, np.uint64) for h in group.column("hashes").to_pylist()],
            np.array(group.column("n").to_pylist(), np.int64))


def group_links(sets: DataFrame, groups: DataFrame, group_postings: int = GROUP_POSTINGS) -> DataFrame:
    """``a, b``: links between classes, enough of them to connect whatever all links connect."""
    held = store(sets.join(groups, sets["class"] == groups["node"]).select("root", "class", "n", "hashes"), "grouped-sets")
    weights = held.groupBy("root").agg(F.sum(F.octet_length("hashes") / 8).cast("long").alias("_postings"))
    large = store(weights.where(F.col("_postings") > group_postings), "large-groups")

    def searched(group: pa.Table) -> pa.Table:
        keys, shingles, sizes = _loaded(group.sort_by("class"))
        found = _links_table(keys, connect(shingles, sizes))
        if len(keys) > 1000:
            release()
        return found

    small = held.join(large, "root", "left_anti").groupBy("root").applyInArrow(searched, "a binary, b binary")
    if large.isEmpty():
        return small
    return small.unionByName(_large_group_links(held.join(large, "root"), group_postings))


def _large_group_links(held: DataFrame, group_postings: int, n_pivots: int = 4) -> DataFrame:
    """Links inside groups too large for a task: pivots first, then the rest by shingle or block by block."""
    pivots = (
        held.withColumn("_n", F.row_number().over(Window.partitionBy("root").orderBy(F.xxhash64("class"), "class")))
        .where(F.col("_n") <= n_pivots)
        .select("root", F.col("class").alias("p_class"), F.col("n").alias("p_n"), F.col("hashes").alias("p_hashes")))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("class", "n", "hashes", "p_class", "p_n", "p_hashes")]
            found = [
                (k, pk) for k, n, h, pk, pn, ph in zip(*columns) if k != pk and links(
                    len(np.intersect1d(np.frombuffer(h, np.uint64), np.frombuffer(ph, np.uint64), assume_unique=True)), n, pn)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], names=["a", "b"])

    to_pivots = store(held.join(pivots, "root").mapInArrow(compared, "a binary, b binary"), "pivot-links")
    joined = components(to_pivots)
    placed = held.join(joined.select(F.col("node").alias("class"), F.col("root").alias("_set")), "class", "left")
    sizes = placed.where(F.col("_set").isNotNull()).groupBy("root", "_set").count()
    main = sizes.groupBy("root").agg(F.max_by("_set", F.struct("count", "_set")).alias("_main"))
    marked = store(
        # Unlinked classes have no set, and a group without any link to its pivots no largest one: all are the rest.
        placed.join(main, "root", "left").withColumn("_rest", ~F.coalesce(F.col("_set") == F.col("_main"), F.lit(False)))
        .select("root", "class", "n", "hashes", "_rest", "_postings"), "large-sets")
    dealt = units(marked, group_postings).withColumn("_block", F.pmod(F.xxhash64("class"), F.col("_blocks")).cast("int"))
    # A block of the rest meets every block of its unit; what is in the largest set is connected.
    rest = dealt.where("_rest").select(
        "_unit", "class", "n", "hashes", F.col("_block").alias("_i"),
        F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_j"), F.lit(True).alias("_query"))
    filled = dealt.where("_rest").select("_unit", F.col("_block").alias("_i")).distinct()
    others = dealt.join(filled, "_unit").select(
        "_unit", "class", "n", "hashes", "_i", F.col("_block").alias("_j"), F.lit(False).alias("_query"))

    def met(group: pa.Table) -> pa.Table:
        keys, shingles, lengths = _loaded(group)
        found = _links_table(keys, [
            (i, j) for i, j in connect(shingles, lengths, np.array(group.column("_query").to_pylist(), bool)) if keys[i] != keys[j]])
        if len(keys) > 1000:
            release()
        return found

    return to_pivots.unionByName(
        rest.unionByName(others).groupBy("_unit", "_i", "_j").applyInArrow(met, "a binary, b binary"))


def block_count(postings: Column, group_postings: int) -> Column:
    half = max(1, group_postings // 2)
    return F.when(postings <= group_postings, 1).otherwise(F.ceil(postings / half)).cast("int")


def units(marked: DataFrame, group_postings: int) -> DataFrame:
    """``_unit, class, n, hashes, _rest, _blocks``: the parts of large groups inside which partners of the rest are
    looked for, in one of two exact ways, whichever sends fewer postings for a group.

    By shingle: the holders of each rare shingle that one of the rest holds; partners share such a shingle. Shingles
    with the same holders count once. This is little in a long chain of unlike texts. By blocks: the whole group,
    every block of the rest against every block. This is less where the same shingles are held by nearly all.
    """
    own = (F.octet_length("hashes") / 8).cast("long")
    weighed = marked.withColumn("_own", own)
    holders = (
        rare_shingles(weighed, "root", "_rest", "_own").groupBy("root", "hash")
        .agg(F.count(F.lit(1)).alias("_held"), F.sum("_own").alias("_sent"), F.max("_rest").alias("_asked"),
             F.bit_xor(F.xxhash64("class")).alias("_x"), F.bit_xor(F.xxhash64(F.lit(1), F.col("class"))).alias("_y"))
        .where(F.col("_asked") & (F.col("_held") > 1))
        .groupBy("root", "_held", "_sent", "_x", "_y").agg(F.min("hash").alias("hash")))
    holders = store(holders.select("root", "hash", "_sent"), "shingle-holders")
    by_shingle = holders.groupBy("root").agg(F.sum(F.col("_sent") * block_count(F.col("_sent"), group_postings)).alias("_by_shingle"))
    by_block = weighed.groupBy("root").agg(
        F.first("_postings").alias("_all"), F.sum(F.when(F.col("_rest"), F.col("_own")).otherwise(0)).alias("_asking"))
    blocks = block_count(F.col("_all"), group_postings)
    ways = store(
        by_block.where(F.col("_asking") > 0).join(by_shingle, "root", "left")
        .select("root", F.coalesce(F.col("_by_shingle") <= blocks * (F.col("_all") + F.col("_asking")), F.lit(True)).alias("_cut"),
                blocks.alias("_blocks")), "large-ways")
    whole = marked.join(ways.where(~F.col("_cut")).select("root", "_blocks"), "root").select(
        F.hex("root").alias("_unit"), "class", "n", "hashes", "_rest", "_blocks")
    chosen = holders.join(ways.where("_cut").select("root"), "root").select(
        "root", "hash", block_count(F.col("_sent"), group_postings).alias("_blocks"))
    placed = rare_shingles(marked, "root").join(chosen, ["root", "hash"]).select(
        F.concat_ws("-", F.hex("root"), F.col("hash").cast("string")).alias("_unit"), F.col("class").alias("_member"), "_blocks")
    cut = placed.join(marked, F.col("_member") == F.col("class")).select("_unit", "class", "n", "hashes", "_rest", "_blocks")
    return whole.unionByName(cut)


def find_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group_postings: int = GROUP_POSTINGS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per document; the component is named by the
    smallest doc_id that links reach."""
    members = store(memberships(docs, doc_id, text), "shingle-members")
    sets = store(shared_shingles(docs, text).dropDuplicates(["class"]), "shared-sets")
    found = store(group_links(sets, candidate_groups(sets), group_postings), "links")
    roots = components(found)
    classes = (
        members.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("_least"))
        .join(roots, F.col("class") == F.col("node"), "left")
        .select("class", F.coalesce("root", "class").alias("_root"), "_least"))
    named = store(classes, "classes")
    least = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    of_class = named.join(least, "_root").select("class", "component_id")
    # Documents with an empty set stay out of the join, where they would share one key.
    alone = members.where(F.col("class").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return members.where(F.col("class").isNotNull()).join(of_class, "class").select(
        "doc_id", "n_shingles", "component_id").unionByName(alone)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, with its own columns: the one with the smallest doc_id (null is
    largest), the first of ties by file and place in it. Rows are told apart by that key, so a repeated or
    null doc_id never keeps a second row of a group; each row without words is a group of its own.

    A table that isn't read from files is stored first, so that every later read sees the same rows.
    """
    rows = row_keys.from_files(docs)
    of_row = F.col(f"`{doc_id}`")
    keyed = rows.select(
        F.struct(of_row.isNull().alias("no_id"), of_row.alias("id"), *row_keys.keys()).alias("key"), F.col(f"`{text}`").alias("text"))
    groups = find_groups(keyed, "key", "text")
    dropped = store(groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id._file", "doc_id._index"), "near-copies")
    kept = row_keys.marked(rows, dropped, [F.col(f"`{c}`") for c in docs.columns], kept=False)
    return kept.drop(*row_keys.KEY).toDF(*docs.columns)
