"""Merkle manifest of a dataset: a digest for every document, source and the whole, with proofs.

A leaf is the sha256 of a document's fields. Per source the leaves ascend by doc_id; every run of 16
nodes becomes the sha256 of their hex text, level by level, until one node remains: the source's
subroot. Subroots, ordered by source, make the root in the same way.

An aligned block of 256 nodes keeps a level as one hex string. Fixed-width substrings of it are
the runs, whose hashes joined are the next level's string, so a block rises two levels without a
shuffle; the blocks' tops are the nodes of the next, 256 times smaller round. On the way down a node's
siblings in a level are the two substrings that flank it in its run, and the segments of a
block's own levels are followed by those of its top.

Scale: positions come from one range sort by (source, doc_id), whose partitions are counted; so a
source that holds a third of all documents lies in many partitions, and no window or group holds
more than a block. Texts are read once and not carried. Rounds are written to the shared folder.

Defined results: a null field is ``-``; a null source is one source, the first; a null doc_id
comes first in its source and is never tampered with; rows with one doc_id are ordered by leaf, so
equal rows are interchangeable; a lone leaf is its source's subroot, a lone subroot the root (the
proof of no siblings is the sha256 of nothing); a text of any length is one field; an empty table gives an
empty table; other columns are left out.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.sinks.files import store

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_FAN = 16
_HEX = 64  # characters of a digest
BLOCK = _FAN * _FAN
_PATH = "array<struct<left:binary,right:binary>>"


def digest(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def _field(column: Column) -> Column:
    value = column.cast("string")
    return F.when(column.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, **replaced: Column) -> Column:
    """The digest of a row's fields; ``replaced`` gives other values of some."""
    return digest(F.concat(*[_field(replaced.get(name, docs[f"`{name}`"])) for name in fields]))


def lower_letters(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


# ---------------------------------------------------------------- positions

def ranked(nodes: DataFrame, group: str, *order: str) -> DataFrame:
    """The nodes with their place ``_pos`` (from 0) in their group and the group's size ``_n``.

    One range sort by group and order; places are counted per partition and group, so a
    group may be spread over any number of partitions.
    """
    rows = store(
        nodes.orderBy(F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order])
        .withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), "ranked-nodes")
    runs = rows.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_here"), F.min("_at").alias("_first"))
    of_group = Window.partitionBy(group)
    before = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        F.col(group).alias("_start_group"), F.col("_part").alias("_start_part"), "_first",
        F.coalesce(F.sum("_here").over(before), F.lit(0)).alias("_start"), F.sum("_here").over(of_group).alias("_n"))
    same = rows[group].eqNullSafe(F.col("_start_group")) & (F.col("_part") == F.col("_start_part"))
    return (
        rows.join(starts, same).withColumn("_pos", F.col("_start") + F.col("_at") - F.col("_first"))
        .drop("_at", "_part", "_first", "_start", "_start_group", "_start_part"))


# ---------------------------------------------------------------- levels

def _parents(level: Column) -> Column:
    """The level above, as one string: the hashes of the runs of a level's string."""
    last = F.floor((F.octet_length(level) - 1) / (_FAN * _HEX)).cast("int")
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(F.substring(level, i * (_FAN * _HEX) + 1, F.lit(_FAN * _HEX)), 256))
    return F.array_join(runs, "").cast("binary")


def _blocks(nodes: DataFrame, group: str) -> DataFrame:
    """``group, _block, _n, _items, _levels, _top``: levels below the top as strings, lowest first.

    ``nodes`` has ``group, _pos, _n, _node, _item``.
    """
    gathered = nodes.groupBy(group, F.floor(F.col("_pos") / BLOCK).alias("_block")).agg(
        F.max("_n").alias("_n"), F.sort_array(F.collect_list(F.struct("_pos", "_node", "_item"))).alias("_nodes"))
    leveled = gathered.withColumn("_l0", F.array_join(F.col("_nodes._node"), "").cast("binary"))
    leveled = leveled.withColumn("_l1", F.when(F.col("_n") > 1, _parents(F.col("_l0"))))
    leveled = leveled.withColumn("_l2", F.when(F.col("_n") > _FAN, _parents(F.col("_l1"))))
    depth = F.when(F.col("_n") == 1, 0).when(F.col("_n") <= _FAN, 1).otherwise(2)
    return leveled.select(
        group, "_block", "_n", F.col("_nodes._item").alias("_items"),
        F.slice(F.array("_l0", "_l1"), F.lit(1), depth).alias("_levels"),
        F.coalesce("_l2", "_l1", "_l0").cast("string").alias("_top"))


def _rise(nodes: DataFrame, group: str) -> list[DataFrame]:
    """The stored blocks of every round; in the last each group has one block."""
    rounds = []
    while True:
        blocks = store(_blocks(nodes, group), f"merkle-{group.strip('_')}-{len(rounds)}")
        rounds.append(blocks)
        if blocks.where(F.col("_n") > BLOCK).isEmpty():
            return rounds
        nodes = blocks.select(
            group, F.col("_block").alias("_pos"), F.ceil(F.col("_n") / BLOCK).alias("_n"), F.col("_top").alias("_node"), F.lit(None).cast("int").alias("_item"))


def _flanks(level: Column, depth: Column, place: Column) -> Column:
    """The substrings on either side of a node within its run."""
    at = F.floor(place / F.when(depth == 0, 1).otherwise(_FAN)).cast("int")
    inside = at % _FAN
    return F.struct(
        F.substring(level, (at - inside) * _HEX + 1, inside * _HEX).alias("left"),
        F.substring(level, (at + 1) * _HEX + 1, (_FAN - 1 - inside) * _HEX).alias("right"))


def _descend(rounds: list[DataFrame], group: str, tops: DataFrame) -> DataFrame:
    """``_item`` of every first-round node with its ``_path`` up to the root, and the other columns of ``tops``.

    ``tops`` has, per group, the path above the group's top (``_path``) and columns to hand down.
    """
    handed = [c for c in tops.columns if c not in (group, "_path")]
    above = tops.select(group, F.lit(0).cast("long").alias("_pos"), "_path", *handed)
    for blocks in reversed(rounds):
        upper = above.select(F.col(group).alias("_upper"), F.col("_pos").alias("_upper_pos"), F.col("_path").alias("_above"), *handed)
        met = blocks.join(upper, blocks[group].eqNullSafe(F.col("_upper")) & (blocks["_block"] == F.col("_upper_pos")))
        nodes = met.select(group, "_block", "_levels", "_above", *handed, F.posexplode("_items").alias("_place", "_item"))
        own = F.transform("_levels", lambda level, depth: _flanks(level, depth, F.col("_place")))
        above = nodes.select(
            group, (F.col("_block") * BLOCK + F.col("_place")).alias("_pos"), "_item", F.concat(own, F.col("_above")).alias("_path"), *handed)
    return above


def folded(node: Column, path: Column) -> Column:
    """The root that a node and its sibling segments lead to."""
    return F.aggregate(path, node.cast("binary"), lambda held, s: digest(F.concat(s["left"], held, s["right"])).cast("binary")).cast("string")


def proof_digest(path: Column) -> Column:
    """The hash of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"]).cast("string")), ""))


# ---------------------------------------------------------------- manifest

def manifest(leaves: DataFrame, group: str = "source") -> DataFrame:
    """``_item`` of each leaf with ``_path`` (its sibling segments up to the root), ``subroot`` and ``root``.

    ``leaves`` has ``group``, the order columns ``doc_id`` and ``_node`` (the leaf's hex digest), and ``_item``.
    """
    rounds = _rise(ranked(leaves, group, "doc_id", "_node"), group)
    subroots = rounds[-1].select(group, F.col("_top").alias("_node"))
    listed = ranked(subroots.withColumn("_tree", F.lit(0)), "_tree", group)
    upper = _rise(listed.withColumn("_item", F.struct(group, F.col("_node").alias("subroot"))), "_tree")
    root = upper[-1].select("_tree", F.array().cast(_PATH).alias("_path"), F.col("_top").alias("root"))
    tops = _descend(upper, "_tree", root).select(f"_item.{group}", "_item.subroot", "_path", "root")
    return _descend(rounds, group, tops)


def verify(docs: DataFrame, tampered: Column, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every document.

    Where ``tampered`` (a condition on the document's columns) holds, the root is folded from the leaf with
    its text's A-Z lower-cased; elsewhere from the leaf itself. The siblings are the original ones.
    """
    changed = F.when(tampered, leaf_digest(docs, fields, text=lower_letters(docs["`text`"])))
    hashed = store(docs.select(
        docs["`source`"].alias("source"), docs["`doc_id`"].alias("doc_id"), leaf_digest(docs, fields).alias("_node"), changed.alias("_changed")),
        "merkle-leaves")
    leaves = hashed.select("source", "doc_id", "_node", F.struct("doc_id", F.col("_node").alias("leaf"), F.col("_changed").alias("changed")).alias("_item"))
    found = manifest(leaves).select("_item.doc_id", "_item.leaf", "_item.changed", "subroot", "root", "_path")
    shown = F.coalesce("changed", "leaf")
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("_path")).alias("proof_sha256"),
        folded(shown, F.col("_path")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
