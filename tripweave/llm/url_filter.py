"""URL filter: logistic regression on hashed character n-grams of host and path, under rules.

The model is fitted from a small labelled URL table given by the caller (``SEED_URLS`` is one of twenty
kinds of sites; hosts known by their documents may be added, at most ``max_labelled`` rows, collected to
the driver: a documented bound) and sent to the tasks as one weight per hash bucket. Judging is
a map over the rows; memory per url grows with its length, as all its n-grams are hashed. A rule names a host and a path prefix and, where the longest fitting rule
exists, decides instead of the model.

Defined results: null, empty and malformed urls (no ``://``) have empty host and path, fit no
rule and get the model's verdict on empty strings; repeated rows are judged alike; ties between
rules cannot occur, as the longest fitting rule is one string; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.labelled_urls import labelled_urls

# The labelled table for a start without labels of one's own.
SEED_URLS = labelled_urls()


@dataclass(frozen=True)
class Rule:
    target: str  # host and path prefix, like ``example.net/en/``
    verdict: str

    @property
    def host(self) -> str:
        return self.target.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.target.partition("/")[2] if "/" in self.target else ""


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    bias: float
    lengths: tuple[int, ...]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits the host (or a parent of it) and begins the path; else null."""
    branches = None
    for rule in sorted(rules, key=lambda r: (-len(r.target), r.target)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        branches = F.when(fits, rule.target) if branches is None else branches.when(fits, rule.target)
    return branches if branches is not None else F.lit(None).cast("string")


def buckets(host: str, path: str, lengths: tuple[int, ...], size: int) -> list[int]:
    """Distinct hash buckets of the character n-grams; host and path have their own."""
    found = set()
    for kind, value in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in lengths:
            found.update(kind + value[i:i + n] for i in range(len(value) - n + 1))
    return [zlib.crc32(gram.encode("utf-8", "replace")) % size for gram in found]


def _split(url: str | None) -> tuple[str, str]:
    before, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    at = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    path = rest[at:]
    end = min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at])
    return host, path[:end]


def fit(
    labelled: list[tuple[str, int]], lengths: tuple[int, ...] = (3, 4, 5), size: int = 1 << 16,
    rounds: int = 200, penalty: float = 1e-4,
) -> UrlModel:
    """Logistic regression by adaptive gradient steps over the whole (small) table, in a fixed order."""
    labelled = sorted(set(labelled))
    rows = [buckets(*_split(url), lengths, size) for url, _ in labelled]
    index = np.array([b for row in rows for b in row], np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(row) for row in rows])
    value = (1 / np.sqrt([max(1, len(row)) for row in rows]))[owner]
    target = np.array([label for _, label in labelled], np.float64)
    share = min(max(target.mean(), 1e-3), 1 - 1e-3)
    balance = np.where(target == 1, 0.5 / share, 0.5 / (1 - share)) / len(rows)
    weights, seen, bias, bias_seen = np.zeros(size), np.full(size, 1e-8), 0.0, 1e-8
    for _ in range(rounds):
        margin = np.bincount(owner, weights[index] * value, len(rows)) + bias
        error = (1 / (1 + np.exp(-margin)) - target) * balance
        slope = np.bincount(index, error[owner] * value, size) + penalty * weights
        seen += slope * slope
        weights -= 0.5 * slope / np.sqrt(seen)
        bias_seen += error.sum() ** 2
        bias -= 0.1 * error.sum() / np.sqrt(bias_seen)
    return UrlModel(weights, float(bias), lengths)


def score(url: str | None, model: UrlModel) -> float:
    """Probability that a url is unwanted."""
    found = buckets(*_split(url), model.lengths, len(model.weights))
    margin = model.weights[found].sum() / np.sqrt(max(1, len(found))) + model.bias
    return float(1 / (1 + np.exp(-margin)))


def site_of(url: str) -> str:
    """The host without a leading ``www``, ``m`` or ``blog`` and without its last two labels: what names a site."""
    labels = _split(url)[0].split(".")
    named = labels[1:] if labels[0] in ("www", "m", "blog") else labels
    return ".".join(named[:-2] or named)


def held_out_scores(labelled: list[tuple[str, int]], folds: int = 10) -> list[tuple[float, int]]:
    """``score, label`` of every row by a model that has not seen its site (folds by a hash of the site)."""
    fold = [zlib.crc32(site_of(url).encode("utf-8", "replace")) % folds for url, _ in labelled]
    found = []
    for k in sorted(set(fold)):
        model = fit([row for row, f in zip(labelled, fold) if f != k])
        found += [(score(url, model), label) for (url, label), f in zip(labelled, fold) if f == k]
    return found


def blocking_threshold(labelled: list[tuple[str, int]], most_false: float = 0.02, folds: int = 10) -> float:
    """The least score from which at most ``most_false`` of the wanted urls of unseen sites are blocked; 0.5 at least.

    An address of unknown words scores about one half, so a filter that blocks from there on would be a coin.
    """
    wanted = sorted((s for s, label in held_out_scores(labelled, folds) if label == 0), reverse=True)
    allowed = int(most_false * len(wanted))
    return max(0.5, float(np.nextafter(wanted[allowed], 1))) if len(wanted) > allowed else 0.5


def labelled_by_documents(
    pages: DataFrame, labels: DataFrame, url: str = "url", doc_id: str = "doc_id", max_labelled: int = 4_000,
    least_blocked: int = 5, least_z: float = 3.0,
) -> list[tuple[str, int]]:
    """Labelled hosts of a page table by the documents that they show: at most ``max_labelled`` hosts with one
    url each, half of the bound for each label, by hash. The words of a host play no part.

    A host is unwanted if at least half of its labelled documents, ``least_blocked`` or more, are toxic or of
    low quality, and wanted if their share is at most half of the share in all documents; in both cases the number
    must be ``least_z`` standard deviations from what that share would give. All other hosts are unknown and left
    out. A page's document is the one whose doc_id is the last number of its url's path; a document with several
    labels counts as its worst.
    """
    shown = (
        pages.select(F.col(f"`{url}`").alias("_url")).where(F.col("_url").contains("://"))
        .groupBy(
            host_of(F.col("_url")).alias("_host"),
            F.expr(r"try_cast(regexp_extract(split(_url, '[?#]')[0], '([0-9]+)[^0-9]*$', 1) as bigint)").alias("_doc"))
        .agg(F.min("_url").alias("_url")))
    known = (
        labels.select(F.col(f"`{doc_id}`").cast("long").alias("_doc"),
                      F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1)
                      .when(F.col("toxic").isNotNull() | F.col("quality").isNotNull(), 0).alias("_bad"))
        .where(F.col("_doc").isNotNull() & F.col("_bad").isNotNull()).groupBy("_doc").agg(F.max("_bad").alias("_bad")))
    share = known.agg(F.avg("_bad")).first()[0]
    if share is None or share in (0, 1):
        return []
    spread = F.sqrt(F.col("_n") * share * (1 - share))
    far = (F.col("_bad") - F.col("_n") * share) / spread
    hosts = (
        shown.where(F.col("_doc").isNotNull()).join(known, "_doc")
        .groupBy("_host").agg(F.min("_url").alias("_url"), F.count(F.lit(1)).alias("_n"), F.sum("_bad").alias("_bad"))
        .withColumn("_label", F.when((2 * F.col("_bad") >= F.col("_n")) & (F.col("_bad") >= least_blocked) & (far >= least_z), 1)
                    .when((F.col("_bad") <= F.col("_n") * share / 2) & (far <= -least_z), 0))
        .where(F.col("_label").isNotNull()))
    half = max_labelled // 2
    # One task takes the least of all partitions, so the driver gets no more than the bound.
    parts = [hosts.where(F.col("_label") == label).orderBy(F.xxhash64("_host")).limit(half).coalesce(1) for label in (0, 1)]
    return [(r["_url"], r["_label"]) for part in parts for r in part.collect()]


def judge(
    pages: DataFrame, model: UrlModel, rules: list[Rule], page_id: str = "page_id", url: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row."""
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"), host_of(F.col(f"`{url}`")).alias("host"),
        path_of(F.col(f"`{url}`")).alias("path"), F.col(f"`{url}`").alias("_url"))
    id_type = rows.schema["page_id"].dataType.simpleString()
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score(u, sent.value) for u in batch.column("_url").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array(scores, pa.float64())],
                names=["page_id", "host", "path", "score"])

    verdicts = {rule.target: rule.verdict for rule in rules}
    of_rule = F.lit(None).cast("string")
    for target, verdict in verdicts.items():
        of_rule = F.when(F.col("rule") == target, verdict).otherwise(of_rule)
    return (
        rows.mapInArrow(scored, f"page_id {id_type}, host string, path string, score double")
        .withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
        .select("page_id", "host", "path", "rule",
                F.coalesce(of_rule, F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"),
                "score"))
