"""The manifest against a plain Python tree, on odd rows and over several rounds."""

from __future__ import annotations

import hashlib
import zlib
from itertools import groupby

from pyspark.sql import functions as F

from tripweave.llm import merkle, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, _pos int, `a.b` int"


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text) -> str:
    values = [row[0], row[1], row[2], row[3], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The top of the nodes and each node's siblings, level by level, as (left, right)."""
    paths, places, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, p in enumerate(places):
            run = level[p // 16 * 16:p // 16 * 16 + 16]
            paths[i].append(("".join(run[:p % 16]), "".join(run[p % 16 + 1:])))
        level = [h("".join(level[i:i + 16])) for i in range(0, len(level), 16)]
        places = [p // 16 for p in places]
    return level[0], paths


def brute(rows: list[tuple]) -> list[tuple]:
    first = lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4]))
    named = lambda r: (r[1] is not None, (r[1] or "").encode())
    groups = [sorted(g, key=first) for _, g in groupby(sorted(rows, key=named), key=named)]
    trees = [climb([leaf(r, r[4]) for r in g]) for g in groups]
    root, tops = climb([top for top, _ in trees])
    out = []
    for g, (subroot, paths), above in zip(groups, trees, tops):
        for row, path in zip(g, paths):
            shown = row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and shown is not None:
                shown = "".join(c.lower() if "A" <= c <= "Z" else c for c in shown)
            node = leaf(row, shown)
            for left, right in path + above:
                node = h(left + node + right)
            out.append((row[0], leaf(row, row[4]), subroot, root, h("".join(a + b for a, b in path + above)), node, node == root))
    return sorted(out, key=repr)


def found(rows, values):
    docs = rows.of(SCHEMA, *((*v, 1, 2) for v in values))
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return rows.back(merkle.verify(docs, tampered))


ODD = [(i, None if i % 3 else "sö", "en", i, f"Text {i}") for i in range(40)] + [
    (None, "b", None, None, None), (None, "b", "de", 5, ""), (7, "b", "de", 5, "AÄ"), (7, "b", "de", 5, "AÄ"), (7, "b", "fr", 5, "AÄ"),
    (-3, "", "x", -1, "W " * 200_000), (10, "lone", "en", None, "Same")]


def test_manifest_equals_plain_tree(rows):
    assert found(rows, ODD) == brute(ODD)
    for values in (ODD[:1], [ODD[-1]], [(i, f"s{i:03}", "en", 1, "T") for i in range(20)]):
        assert found(rows, values) == brute(values)
    assert found(rows, []) == []


def test_several_rounds_and_a_hot_source(rows):
    values = [(i * 3, "hot", "en", 1, f"Text {i}") for i in range(4500)] + [(i, f"s{i % 300:03}", "en", 1, f"t{i}") for i in range(900)]
    assert found(rows, values) == brute(values)


def test_query_columns(spark):
    got = queries.QUERIES["op11_merkle_manifest"](spark, "/root/testdata/sf0.001")
    assert got.dtypes == [("doc_id", "bigint"), *((c, "string") for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", "boolean")]
