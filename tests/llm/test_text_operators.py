"""Odd rows and brute-force versions of the text operators."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np

from tripweave.llm import (
    exact_dedup, html_text, language_id, packing, quality_classifier, quality_rules, sharding, shingle_join, url_filter,
)

SCHEMA = "doc_id long, text string, _group string, `a.b` int"
ODD = [(1, None, "x", 1), (2, "", "x", 1), (3, "same text", "x", 1), (3, "same text", "x", 1), (4, "same text", None, None),
       (None, "same text", "x", 2), (5, "w " * 30_000, "y", 1), (6, "w " * 30_000, "y", 1), (7, " \n\t", "z", 1), (8, "p" * 700 + "a", "z", 1), (9, "p" * 700 + "b", "z", 1)]


def test_exact_copies(rows):
    docs = rows.of(SCHEMA, *ODD)
    got = rows.back(exact_dedup.find_copies(docs), "doc_id", "keep_id", "group_size", "kept")
    same = sorted([(1, 2, 2, False), (2, 2, 2, True), (3, 4, 4, False), (3, 4, 4, False), (4, 4, 4, True), (None, 4, 4, False),
                   (5, 6, 2, False), (6, 6, 2, True), (7, 7, 1, True), (8, 8, 1, True), (9, 9, 1, True)], key=repr)
    assert got == same
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 6, 7, 8, 9]
    repeated = rows.of(SCHEMA, *[(1, "t", "x", 1)] * 5)
    assert exact_dedup.drop_copies(repeated).count() == 1
    assert exact_dedup.find_copies(docs.limit(0)).count() == 0


def brute_groups(texts: dict[int, str]) -> dict[int, int]:
    sets = {}
    for k, t in texts.items():
        w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[k] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {k: k for k in texts}
    for _ in texts:
        for a, b in itertools.combinations(texts, 2):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                label[a] = label[b] = min(label[a], label[b])
    return label


def near_copies(seed: int, n: int) -> dict[int, str]:
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(400)}" for _ in range(60)] for _ in range(4)]
    out = {0: None, 1: "", 2: "one two", 3: "One TWO", 4: "É é x y z a", 5: "é é x y z a"}
    for i in range(6, n):
        words = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(5000)}"
        out[i] = " ".join(words)
    return out


def test_shingle_groups_equal_brute_force(rows):
    texts = near_copies(3, 60)
    docs = rows.of(SCHEMA, *((k, t, "clash", 0) for k, t in texts.items()))
    expected = brute_groups(texts)
    for postings in (shingle_join.GROUP_POSTINGS, 300):  # the second: every group is large
        got = {r["doc_id"]: r["component_id"] for r in shingle_join.find_groups(docs, group_postings=postings).collect()}
        assert got == expected
    kept = shingle_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, v in expected.items() if k == v)
    assert shingle_join.find_groups(docs.limit(0)).count() == 0


def test_quality_rules(rows):
    docs = rows.of(SCHEMA, *ODD, (20, " ".join(f"word{i}" for i in range(80)), "g", 1), (21, " ".join(["a b c"] + [f"u{i}" for i in range(60)] + ["a b c"]), "g", 1))
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert (got[1]["n_words"], got[1]["base_failed"], got[1]["kept"]) == (0, True, False)
    assert got[5]["n_repeat_words"] == 30_000 and got[20]["kept"] and got[21]["n_repeat_words"] == 6
    kept = quality_rules.keep_passing(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [20, 21]
    assert quality_rules.keep_passing(docs.limit(0)).count() == 0


def test_shards_are_exact(rows):
    docs = rows.of(SCHEMA, *ODD, *((i, "t", "hot", 1) for i in range(100, 300))).repartition(7)
    got = sharding.shard_rows(docs.select("doc_id", "text"), 16, block_rows=4).collect()
    sizes = np.bincount([r["shard"] for r in got], minlength=16)
    assert len(got) == len(ODD) + 200 and sizes.max() - sizes.min() <= 1
    for shard in range(16):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sizes[shard]))
    assert sharding.shard_rows(docs.limit(0), 16).count() == 0


def test_matrix_sums_and_large_draws():
    matrix = sharding.communication_matrix({0: 10, 1: 0, 5: 23}, 4, 1)
    assert [int(v.sum()) for v in matrix.values()] == [10, 0, 23] and sum(matrix.values()).tolist() == [9, 8, 8, 8]
    random_ = np.random.default_rng(0)
    drawn = [sharding._hypergeometric(random_, 2_000_000_000, 6_000_000_000, 10_000) for _ in range(200)]
    assert abs(np.mean(drawn) - 2500) < 15 and 30 < np.std(drawn) < 58


def test_packing_holds_every_capacity():
    lengths = np.random.default_rng(2).integers(1, 2049, 800)
    for score in ("norm", "dot"):
        capacity = packing.Capacity(2048, 3, 2_500_000)
        lengths_ok = lengths[lengths ** 2 <= capacity.attention]
        sequence, offset = packing.pack_block(lengths_ok, capacity, packing.Weights(), score)
        for s in np.unique(sequence):
            inside = np.flatnonzero(sequence == s)
            held = lengths_ok[inside[np.argsort(offset[inside])]]
            assert held.sum() <= 2048 and len(held) <= 3 and (held ** 2).sum() <= 2_500_000
            assert sorted(offset[inside]) == [0, *np.cumsum(held)[:-1]]
    one, _ = packing.pack_block(lengths, packing.Capacity(), packing.Weights(), "norm")
    assert len(np.unique(one)) <= 1.08 * lengths.sum() / 2048


def test_url_parts_and_rules(rows):
    urls = [None, "", "no scheme", "HTTP://WWW.A.Example.NET/en/x?q=/b", "http://example.net", "x://notexample.net#/en/",
            "https://m.example.com/de/1", "https://b.org/fr/1#t", "http://casino-win.example.com/en/2"]
    pages = rows.of("page_id long, url string, host string", *((i, u, "clash") for i, u in enumerate(urls)))
    rules = [url_filter.Rule("net/", "block"), url_filter.Rule("example.net/en/", "allow"),
             url_filter.Rule("example.com/de/", "block"), url_filter.Rule("org/fr/", "allow")]
    got = {r["page_id"]: r for r in url_filter.judge(pages, url_filter.fit(url_filter.SEED_URLS), rules).collect()}
    assert [(got[i]["host"], got[i]["path"]) for i in range(3)] == [("", "")] * 3
    assert (got[3]["host"], got[3]["path"], got[3]["rule"]) == ("www.a.example.net", "/en/x", "example.net/en/")
    assert [got[i]["rule"] for i in range(4, 9)] == [None, None, "example.com/de/", "org/fr/", None]
    assert [got[i]["verdict"] for i in (3, 6, 7, 8)] == ["allow", "block", "allow", "block"]
    for i, url in enumerate(urls):
        assert url_filter._split(url) == (got[i]["host"], got[i]["path"])


def test_languages(rows):
    rng = random.Random(1)
    words = {"en": "the and that with from have this".split(), "de": "der und nicht mit eine auch wird".split()}
    made = [(i, " ".join(rng.choices(words[g], k=60)), g) for i, g in enumerate(["en", "de"] * 20)]
    docs = rows.of("doc_id long, text string, lang string", *made, (100, None, "en"), (101, "123 !", "de"), (102, "", None))
    model = language_id.fit(docs)
    got = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    assert all(got[i]["lang_pred"] == g and 0 <= got[i]["score"] <= 1 for i, _, g in made)
    assert [got[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3
    assert language_id.predict(docs, language_id.fit(docs.limit(0))).where("lang_pred <> 'und'").count() == 0


def test_quality_classifier(rows):
    good, bad = "Plain words in a line of prose number", "Some*** noisy### words%%% here&&& number***"
    made = [(i, f"{good if i % 2 else bad} {i} {i * 7}", i % 2) for i in range(60)]
    docs = rows.of("doc_id long, text string, `a.b` int", *((i, t, 1) for i, t, _ in made), (100, None, 1), (101, "", 1))
    labels = rows.of("doc_id long, quality int", *((i, q) for i, _, q in made), (None, 1), (5, None))
    model = quality_classifier.fit(docs, labels)
    got = {r["doc_id"]: r["s"] for r in docs.withColumn("s", quality_classifier.score_column(docs, model)).collect()}
    assert all((got[i] >= 0.5) == bool(q) for i, _, q in made) and got[100] == got[101] == model.prior
    assert quality_classifier.keep_good(docs, model).columns == docs.columns
    empty = quality_classifier.fit(docs, labels.limit(0))
    assert quality_classifier.keep_good(docs, empty).count() == docs.count()


def test_html_blocks():
    page = ("<head><title>t</title></head><body><nav><a href='/'>Home</a></nav><p>One &amp; two<br>three<p>Next"
            "<script>var t='</p>';</script> part<!-- x --></p><footer>&copy; x</footer>")
    assert [leaf.text for leaf in html_text.leaves(page)] == ["Home", "One & two three", "Next part", "© x"]
    assert html_text.leaves("") == [] and html_text.leaves("plain")[0].text == "plain"
    assert html_text.leaves('<a "' + '"x' * 5000)  # stray quotes end in linear time
    lines = [f"A line of running text with number {i} and some more words." for i in range(40)]
    random_ = np.random.default_rng(1)
    made = [html_text.leaves(html_text.template_page(random_, lines)) for _ in range(140)]
    strip = lambda leaf: html_text.Leaf(tuple(t for t in leaf.path if not t.startswith("data-main")), leaf.text, leaf.link_share, False)
    pages, labels = [[strip(x) for x in p] for p in made], [np.array([x.marked for x in p], np.float32) for p in made]
    model = html_text.train(pages[:110], labels[:110], rounds=10)
    found = np.concatenate(html_text.probabilities(model, pages[110:])) >= 0.5
    assert (found == np.concatenate(labels[110:])).mean() > 0.9


def test_html_skipped_elements_end():
    def found(page: str) -> list[str]:
        return [leaf.text for leaf in html_text.leaves(page)]

    assert found("<html><head><title>t</title><body><article><p>Kept text</p></article>") == ["Kept text"]
    assert found("<head><meta charset=x><title>t</title><link rel=y><div>One</div><p>Two</p>") == ["One", "Two"]
    assert found("<head><title>a < b</title><style>p{}</style>\nBare text<p>Two</p>") == ["Bare text", "Two"]
    assert found("<head><title>t</title><script>1</script></head><body><p>One</p>") == ["One"]
    assert found("<p>One <svg class='i' /> two</p><p>Three</p><svg><path d='x'/></svg><p>Four</p>") == ["One two", "Three", "Four"]
    assert found("<p>One</p><svg/><p>Two</p>") == ["One", "Two"]
    assert found("<svg><text>icon</text></svg><p>Two</p>") == ["Two"]
    assert found("<svg><path><p>One</p><svg><text>icon</text></svg><p>Two</p>") == ["One", "Two"]
    assert found("<svg><foreignObject><p>icon</p></foreignObject></svg><p>Two</p>") == ["Two"]
    for name in ("noscript", "template", "iframe", "svg"):
        assert found(f"<p>One</p><{name} src='a>b'><p>Two</p>") == ["One", "Two"]
        assert found(f"<p>One</p><{name}>left out</{name} ><p>Two</p>") == ["One", "Two"]
    assert found("<header><p>One</p></header><svg-icon>Two</svg-icon>") == ["One", "Two"]
    assert found("<p>One</p><script>var t = 1;") == found("<p>One</p><!-- x") == found("<p>One</p><style>p") == ["One"]
    assert len(found("<p>x</p>" + "<svg>" * 50_000 + "<template>" * 50_000)) == 1  # looked for once


def test_every_language_is_learned(rows):
    rng = random.Random(4)
    words = {f"l{g:02}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)] for g in range(70)}
    made = [(100 * n + i, " ".join(rng.choices(w, k=40)), g) for n, (g, w) in enumerate(words.items()) for i in range(3)]
    docs = rows.of("doc_id long, text string, lang string", *made)
    model = language_id.fit(docs)
    assert sorted(g for g, _ in model.dictionaries) == sorted(words)
    assert {(r["doc_id"], r["lang_pred"]) for r in language_id.predict(docs, model).collect()} == {(i, g) for i, _, g in made}


def test_a_hot_id_takes_no_other_place(rows):
    plain, noisy = "Plain words in a line of prose number", "Some*** noisy### words%%% here&&& number***"
    made = [(i, f"{plain if i % 2 else noisy} {i}") for i in range(40)]
    docs = rows.of("doc_id long, text string, lang string", *((i, t, "en") for i, t in made),
                   *((i, f"{n} copies of one id", "en") for n in range(60) for i in (7, 8)), *((i, t, "de") for i, t in made[:9]))
    labels = rows.of("doc_id long, quality int", *((i, i % 2) for i, _ in made), *[(7, 1), (8, 0)] * 60)
    model = quality_classifier.fit(docs, labels, max_labelled=40)
    assert len(model.labels) == 40 and model.labels.sum() == 20
    assert len(np.unique(model.vectors.round(4), axis=0)) > 30

    learned = dict(language_id.fit(docs, docs_per_language=40).dictionaries)
    assert learned["en"].count(b"copies") == 2 and learned["en"].count(b"number") == 38 and learned["de"].count(b"number") == 9
