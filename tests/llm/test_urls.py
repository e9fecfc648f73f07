"""The url filter against a plain version, its labels, and what it makes of unseen sites."""

from __future__ import annotations

import math
import zlib

import numpy as np

from tripweave.llm import queries, url_filter
from tripweave.llm.labelled_urls import labelled_urls


def plain_score(url, model):
    """The probability by dictionaries and loops."""
    rest = (url or "").split("://", 1)
    host = path = ""
    if len(rest) == 2:
        for i, c in enumerate(rest[1]):
            if c in "/?#":
                host, path = rest[1][:i], rest[1][i:]
                break
        else:
            host = rest[1]
        host = host.translate({c: c + 32 for c in range(65, 91)})
        for mark in "?#":
            path = path.split(mark)[0]
    grams = {}
    for kind, value in {"h": f"^{host}$", "p": f"^{path}$"}.items():
        for n in model.lengths:
            for start in range(0, len(value) - n + 1):
                grams[kind + value[start:start + n]] = True
    margin = sum(model.weights[zlib.crc32(g.encode()) % len(model.weights)] for g in grams)
    return 1 / (1 + math.exp(-(margin / math.sqrt(max(1, len(grams))) + model.bias)))


def test_verdicts_equal_a_plain_version(rows):
    model = url_filter.fit(url_filter.SEED_URLS)
    urls = [None, "", "no scheme", "x://", "HTTP://A.Example.COM/Free-Bets?x#y", "http://é.example.org/ü/1#t", "http://h.example.com/" + "ab/" * 20_000,
            *(u for u, _ in url_filter.SEED_URLS[::37])]
    pages = rows.of("page_id long, url string, score string, _url int", *((i % 9, u, "clash", 1) for i, u in enumerate(urls)), (None, urls[-1], None, None))
    got = url_filter.judge(pages, model, queries.URL_RULES, threshold=0.6).collect()
    expected = [plain_score(u, model) for u in [*urls, urls[-1]]]
    assert len(got) == len(expected)
    assert np.allclose([r["score"] for r in got], expected, rtol=1e-9)
    targets = {r.target: r.verdict for r in queries.URL_RULES}
    for r, wanted in zip(got, expected):
        assert r["verdict"] == targets.get(r["rule"], "block" if wanted >= 0.6 else "allow")
    assert url_filter.judge(pages.limit(0), model, queries.URL_RULES).count() == 0


def test_unseen_sites():
    found = url_filter.held_out_scores(url_filter.SEED_URLS)
    assert len(found) == len(url_filter.SEED_URLS)
    unwanted, wanted = ([s for s, label in found if label == k] for k in (1, 0))
    area = np.mean([(u > w) + (u == w) / 2 for u in unwanted for w in wanted])
    threshold = url_filter.blocking_threshold(url_filter.SEED_URLS, 0.02)
    assert area > 0.9 and np.mean([w >= threshold for w in wanted]) <= 0.02 < 0.5 < np.mean([u >= threshold for u in unwanted])
    assert url_filter.blocking_threshold([("http://a.example.com/", 1), ("http://b.example.com/", 1)]) == 0.5


def test_table_gives_nothing_away_but_names_and_paths():
    rows = labelled_urls()
    ends = {label: {url_filter._split(u)[0].split(".", 1)[1][-11:] for u, k in rows if k == label} for label in (0, 1)}
    assert ends[0] == ends[1] and len(set(rows)) == len(rows)
    sites = {label: {url_filter.site_of(u) for u, k in rows if k == label} for label in (0, 1)}
    assert not sites[0] & sites[1]


def test_labels_come_from_documents_not_from_words(rows):
    shown = {"good.net": range(100, 160), "bad.net": range(0, 40), "few.net": range(0, 2), "mixed.net": [*range(30, 50), *range(130, 150)],
             "unknown.net": [9999], "casino-a.net": range(100, 140)}
    pages = rows.of("page_id long, url string, doc_id string", *((i, f"https://{h}/en/{i}?p=3", "clash") for h, ids in shown.items() for i in ids),
                    *[(1, "https://good.net/en/101", "clash")] * 90, (2, None, None), (3, "no scheme 1", None), (4, "https://none.net/", None))
    labels = rows.of("doc_id long, quality int, toxic int", *((i, 0, 0) for i in range(40)), *((i, 1, 0) for i in range(40, 160)),
                     *[(5, 1, 1)] * 50, (None, 0, 1))
    got = {url_filter._split(u)[0]: label for u, label in url_filter.labelled_by_documents(pages, labels)}
    assert got == {"good.net": 0, "casino-a.net": 0, "bad.net": 1}
    assert len(url_filter.labelled_by_documents(pages, labels, max_labelled=2)) == 2
    assert url_filter.labelled_by_documents(pages.limit(0), labels) == [] == url_filter.labelled_by_documents(pages, labels.limit(0))
    assert url_filter.labelled_by_documents(pages, labels.where("quality = 1 and toxic = 0")) == []


def test_query_columns(spark):
    got = queries.QUERIES["op1_url_filter"](spark, "/root/testdata/sf0.001")
    types = dict(got.dtypes)
    assert types["host"] == types["path"] == types["rule"] == types["verdict"] == "string"
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    verdicts = {r["page_id"]: r["verdict"] for r in got.collect()}
    assert len(verdicts) == pages.count() and set(verdicts.values()) <= {"allow", "block"}
