"""The block labeller on tables: odd rows, repeated ids, deep pages."""

from __future__ import annotations

import subprocess
import sys

import numpy as np
import pytest

from tripweave.llm import html_text, queries

PAGES = "page_id long, url string, html string, text string, _html int, `a.b` int"
DOCS = "doc_id long, text string, html string"


def page(number: int) -> str:
    lines = "".join(f"<p>This is line {k} of the running text with number {number} in it.</p>" for k in range(6))
    return f"<html><body><nav><a href='/'>Home</a></nav><article>{lines}</article><footer>&copy; Site</footer></body></html>"


def document(number: int) -> str:
    return "\n".join(f"This is line {k} of the running text with number {number} in it." for k in range(6))


@pytest.fixture(scope="module")
def model(spark):
    pages = spark.createDataFrame([(i, f"https://x.net/en/{i}", page(i), "clash", 1, 1) for i in range(40)], PAGES)
    docs = spark.createDataFrame([(i, document(i), "clash") for i in range(40)], DOCS)
    return html_text.fit(pages, docs, max_pages=60)


def test_odd_pages(rows, model):
    made = [(1, "u", page(1)), (1, "u", page(1)), (None, None, page(2)), (2, "u", None), (3, "u", ""), (4, "u", "<p></p>"),
            (5, "u", page(5) * 400), (6, "u", "<nav><a href='/'>Home</a></nav>")]
    frame = rows.of(PAGES, *((*m, "clash", 1, 1) for m in made))
    got = html_text.extract(frame, model)
    assert got.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    found = sorted(got.collect(), key=repr)
    assert len(found) == len(made) and all(r["n_chars"] == len(r["text"]) for r in found)
    by_id = {}
    for r in found:
        by_id.setdefault(r["page_id"], []).append(r["text"])
    assert by_id[1] == ["\n\n".join(document(1).split("\n"))] * 2 and by_id[None] == ["\n\n".join(document(2).split("\n"))]
    assert by_id[2] == by_id[3] == by_id[4] == by_id[6] == [""] and by_id[5][0].count("line 3") == 400
    assert html_text.extract(frame.limit(0), model).count() == 0
    # a block exactly at the threshold counts
    leaf = html_text.leaves(page(1))
    chance = float(html_text.probabilities(model, [leaf])[0][1])
    assert html_text.extract(frame.limit(1), model, threshold=chance).collect()[0]["text"] != ""


def test_repeated_ids_take_no_other_place(rows, model):
    made = [(i, f"https://x.net/en/{i}", page(i)) for i in range(40)] + [(7, "https://x.net/en/7", page(7))] * 300
    pages = rows.of(PAGES, *((*m, "clash", 1, 1) for m in made), (None, "https://x.net/en/3", page(3), "", 1, 1))
    docs = rows.of(DOCS, *((i, document(i), "") for i in range(40)), *[(7, document(7), "")] * 2000, (None, "x", ""), (8, None, ""))
    again = html_text.fit(pages, docs, max_pages=60)
    assert all(np.array_equal(again.weights[k], v) for k, v in model.weights.items())
    assert html_text.fit(pages.limit(0), docs.limit(0), max_pages=20).weights.keys() == model.weights.keys()


def test_deep_pages_take_linear_memory():
    code = (
        "import resource, numpy as np\nfrom tripweave.llm import html_text\n"
        "model = html_text.Labeller(); model.start()\n"
        "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "leaves = html_text.leaves('<div class=\"a\">x' * 100_000 + '</b></i>' * 100_000)\n"
        "assert len(leaves) == 100_000 and leaves[-1].path.size == 200_000\n"
        "html_text.probabilities(model, [leaves])\n"
        "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env={"PYTHONPATH": ":".join(sys.path)})
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 500


def test_paths_give_the_vectors_of_their_tokens():
    for leaf in html_text.leaves("<div class='a b'><p id=x>one</p><p>two</p><ul><li>three<li>four</ul></div>five"):
        assert np.array_equal(html_text._path_vector(leaf.path), html_text._path_vector(tuple(leaf.path)))


def test_query_columns(spark):
    got = queries.QUERIES["op10_html_blocks"](spark, "/root/testdata/sf0.001")
    assert got.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
