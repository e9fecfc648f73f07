"""Main text of web pages by a recurrent labeller of their blocks.

A page becomes its sequence of leaf blocks in page order: the text between block-level tags, with
the path of tags above it. A bidirectional LSTM in numpy reads, per leaf, hashed vectors of the
tag path (tags, classes, ids, roles) and of the words, the length, the share of link text and
the end sign, and labels every block in view of the whole page. The blocks labelled as
main text are joined.

Training is on at most ``max_pages`` pages of two kinds: pages whose document is in the document
table (a block that is found in the document is main text), and pages made from sampled document
lines inside random templates with menus, headers, sidebars, notices, adverts, forms and comments.

Scale: a map over the pages; the model is a few hundred kilobytes and broadcast. Pages of similar
length are labelled together in bounded groups; memory is bounded by the longest page, some kilobytes a
block, however deep its tags nest, as blocks share the paths above them.

Defined results: null, empty and tag-free input have the text that stands outside tags, if it is
labelled as main text, else an empty string; unclosed tags, comments, scripts and styles run to the
end of the page. A head ends at its end tag, at the body or at the first tag or text that cannot
stand in a head; an svg ends at its end tag, at ``/>`` or at the first tag that cannot stand in it;
of a noscript, template, iframe, title or svg without an end only the tag is left out. Repeated rows
are labelled alike; an empty table gives an empty table.
"""

from __future__ import annotations

import html as html_module
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.text_bytes import raw, slices, texts, word_hashes, word_spans

# Fixed values of HTML: elements that do not break a block, elements without an end tag.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements without text of the page, and those that may stand in a head.
SKIPPED = frozenset("noscript template svg iframe".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?:[\"'][^>]*+)?)>", re.S | re.I)
_END_OF = {name: re.compile(rf"</{name}\s*>", re.I) for name in (*SKIPPED, "title")}
# Where an svg ends at the latest: tags of HTML that break out of it, unless they stand in a foreignObject.
_SVG_END = re.compile(
    r"</svg\s*>|<(foreignObject)\b|(?=</?(?:body|p)\b|<(?:article|blockquote|center|dd|div|dl|dt|h[1-6]|hr|img|li|main|menu"
    r"|nav|ol|pre|section|span|table|ul)[\s/>])", re.I)
_CLOSED = re.compile(r"(?<!=)/\s*\Z")
_OPEN_VALUE = re.compile(r"=\s*[^\s\"']+\Z")
_NAMES = re.compile(r"""\b(class|id|role|data-main)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PARTS = re.compile(r"[A-Za-z]+")
PATH_BUCKETS, WORD_BUCKETS, PLAIN = 256, 32, 5


class Path:
    """An element: its own tokens and the path above it, which everything inside shares."""

    __slots__ = ("above", "tokens", "size", "main", "inside", "counts")

    def __init__(self, above: Path | None, tokens: tuple[str, ...]):
        self.above, self.tokens = above, tokens
        self.size = len(tokens) + (above.size if above else 0)
        self.main = "data-main:main" in tokens or (above is not None and above.main)
        self.inside: dict[tuple[str, ...], Path] = {}
        self.counts: np.ndarray | None = None  # of the buckets of all tokens, where it was asked for

    def to(self, tokens: tuple[str, ...]) -> Path:
        """The path of an element inside; equal elements share one."""
        if tokens not in self.inside:
            self.inside[tokens] = Path(self, tokens)
        return self.inside[tokens]

    def __iter__(self) -> Iterator[str]:
        chain, at = [], self
        while at is not None:
            chain.append(at.tokens)
            at = at.above
        return (token for tokens in reversed(chain) for token in tokens)

    def bucket_counts(self) -> np.ndarray:
        """Kept here and in the element above, so a deep page costs one step per block."""
        for place in (self.above, self):
            if place is None or place.counts is not None:
                continue
            chain, at = [], place
            while at is not None and at.counts is None:
                chain.append(at.tokens)
                at = at.above
            place.counts = np.zeros(PATH_BUCKETS, np.float32) if at is None else at.counts.copy()
            for tokens in chain:
                np.add.at(place.counts, _buckets(tokens), 1.0)
        return self.counts


@dataclass
class Leaf:
    path: Path | tuple[str, ...]
    text: str
    link_share: float
    marked: bool


def _attribute_tokens(attributes: str) -> tuple[str, ...]:
    found = []
    for name, value in _NAMES.findall(attributes):
        found += [f"{name.lower()}:{part.lower()}" for part in _PARTS.findall(value)] or [f"{name.lower()}:"]
    return tuple(found)


def leaves(html: str) -> list[Leaf]:
    """The blocks with text, in page order."""
    out: list[Leaf] = []
    top = Path(None, ())
    stack: list[tuple[str, Path]] = []
    opened: Counter[str] = Counter()
    pieces: list[str] = []
    at = link_depth = link_chars = 0
    in_head, endless = False, set()

    def end_of(name: str, attributes: str) -> int | None:
        """Where the content of a skipped element ends; None if nothing ends it."""
        if name == "svg" and _CLOSED.search(attributes) and not _OPEN_VALUE.search(attributes):
            return at
        if name in endless:  # looked for once: no end stands further on
            return None
        end = _SVG_END.search(html, at) if name == "svg" else None
        if end is None or end.group(1):
            end = _END_OF[name].search(html, at)
        if end is None:
            endless.add(name)
        return end and end.end()

    def flush() -> None:
        nonlocal link_chars
        joined = " ".join(html_module.unescape("".join(pieces)).split())
        pieces.clear()
        if joined:
            path = stack[-1][1] if stack else top
            out.append(Leaf(path, joined, min(1.0, link_chars / len(joined)), path.main))
        link_chars = 0

    while token := _TOKEN.search(html, at):
        if token.start() > at:
            text = html[at:token.start()]
            in_head = in_head and text.isspace()
            pieces.append(text)
            if link_depth:
                link_chars += len(text)
        at = token.end()
        name = token.group(3)
        if name is None:
            continue
        name, closes = name.lower(), bool(token.group(2))
        if not closes and (name in SKIPPED or in_head and name == "title"):
            at = end_of(name, token.group(4)) or at
            continue
        if name == "head" and not closes:
            in_head = True
            continue
        if in_head and (name not in ("head", "body", "html") if closes else name in IN_HEAD):
            continue
        in_head = False
        if name in INLINE:
            if name == "a":
                link_depth = max(0, link_depth - 1) if closes else link_depth + 1
            elif name in ("br", "img", "wbr"):
                pieces.append(" ")
            continue
        flush()
        link_depth = 0
        if closes:
            while opened[name]:
                last, _ = stack.pop()
                opened[last] -= 1
                if last == name:
                    break
        elif name not in EMPTY:
            if stack and stack[-1][0] in ("p", "li", "dt", "dd", "option") and (stack[-1][0] == "p" or name == stack[-1][0]):
                opened[stack.pop()[0]] -= 1
            tokens = (f"tag:{name}", *(_attribute_tokens(token.group(4)) if "=" in (token.group(4) or "") else ()))
            stack.append((name, (stack[-1][1] if stack else top).to(tokens)))
            opened[name] += 1
    pieces.append(html[at:])
    flush()
    return out


def _buckets(tokens: Sequence[str], kind: bytes = b"") -> np.ndarray:
    return np.array([zlib.crc32(kind + t.encode()) % PATH_BUCKETS for t in tokens], np.int64)


def _path_vector(path: Path | tuple[str, ...]) -> np.ndarray:
    """Buckets of the path's tokens; the two nearest elements count a second time on their own."""
    if isinstance(path, Path):
        near = (*(path.above.tokens if path.above else ()), *path.tokens)
        counts, size = path.bucket_counts().copy(), path.size + len(near)
    else:
        tags = [i for i, token in enumerate(path) if token.startswith("tag:")]
        near = path[tags[-2] if len(tags) > 1 else 0:]
        counts, size = np.zeros(PATH_BUCKETS, np.float32), len(path) + len(near)
        np.add.at(counts, _buckets(path), 1.0)
    np.add.at(counts, _buckets(near, b"near:"), 1.0)
    return counts / np.sqrt(max(size, 1))


def word_vectors(of_leaves: list[Leaf]) -> np.ndarray:
    """Hashed words (share of each bucket), log length, link share, end sign, digits, position."""
    n = len(of_leaves)
    data, where = raw(pa.array([leaf.text for leaf in of_leaves], pa.string()))
    starts, ends, row = word_spans(data, where)
    bucket = (word_hashes(data, starts, ends) % np.uint64(WORD_BUCKETS)).astype(np.int64)
    counts = np.bincount(row * WORD_BUCKETS + bucket, minlength=n * WORD_BUCKETS).reshape(n, WORD_BUCKETS)
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    length = np.diff(where)
    last = data[where[1:] - 1]
    plain = np.stack([
        np.log1p(length) / 5, [leaf.link_share for leaf in of_leaves], np.isin(last, np.frombuffer(b".!?:", np.uint8)),
        np.minimum(total[:, 0], 50) / 50, np.ones(n)], axis=1)
    return np.concatenate([counts / total, plain], axis=1).astype(np.float32)


@dataclass
class Labeller:
    """One LSTM per direction and a logistic output. ``weights``: name to array."""
    hidden: int = 16
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, seed: int = 5) -> None:
        random, h = np.random.default_rng(seed), self.hidden
        for d in "fb":
            self.weights |= {
                f"{d}_path": random.normal(0, 0.15, (PATH_BUCKETS, 4 * h)), f"{d}_word": random.normal(0, 0.15, (WORD_BUCKETS + PLAIN, 4 * h)),
                f"{d}_state": random.normal(0, 0.2, (h, 4 * h)), f"{d}_bias": np.repeat([0.0, 1.0, 0.0, 0.0], h)}
        self.weights |= {"out": random.normal(0, 0.2, 2 * h), "out_bias": np.zeros(1)}
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def run(self, direction: str, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
        """States over padded sequences (batch, time, 4h); masked steps keep their state."""
        batch, steps, _ = gates.shape
        h = self.hidden
        state, cell = np.zeros((batch, h), np.float32), np.zeros((batch, h), np.float32)
        out, saved = np.zeros((batch, steps, h), np.float32), []
        recurrent = self.weights[f"{direction}_state"]
        for t in (range(steps) if direction == "f" else range(steps - 1, -1, -1)):
            z = gates[:, t] + state @ recurrent
            sig = 1 / (1 + np.exp(-z[:, :3 * h]))
            i, f, o, g = sig[:, :h], sig[:, h:2 * h], sig[:, 2 * h:], np.tanh(z[:, 3 * h:])
            m = mask[:, t:t + 1]
            new_cell = f * cell + i * g
            squashed = np.tanh(new_cell)
            if keep:
                saved.append((t, i, f, o, g, cell, squashed, state, m))
            cell = np.where(m, new_cell, cell)
            state = np.where(m, o * squashed, state)
            out[:, t] = state
        return out, saved

    def back(self, direction: str, saved: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the gate inputs and of the recurrent matrix."""
        h, recurrent = self.hidden, self.weights[f"{direction}_state"]
        batch, steps, _ = d_out.shape
        d_gates = np.zeros((batch, steps, 4 * h), np.float32)
        d_recurrent = np.zeros_like(recurrent)
        d_state, d_cell = np.zeros((batch, h), np.float32), np.zeros((batch, h), np.float32)
        for t, i, f, o, g, cell, squashed, state, m in reversed(saved):
            total = d_state + d_out[:, t]
            d_new = d_cell + total * o * (1 - squashed ** 2)
            z = np.concatenate([d_new * g * i * (1 - i), d_new * cell * f * (1 - f),
                                total * squashed * o * (1 - o), d_new * i * (1 - g ** 2)], axis=1) * m
            d_gates[:, t] = z
            d_recurrent += state.T @ z
            d_state = np.where(m, z @ recurrent.T, total)
            d_cell = np.where(m, d_new * f, d_cell)
        return d_gates, d_recurrent


def _padded(pages: list[list[Leaf]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unique paths (multi-hot), path index, word vectors and mask of pages of one group."""
    steps = max(len(p) for p in pages)
    known: dict[Path | tuple[str, ...], int] = {}
    index, mask = np.zeros((len(pages), steps), np.int64), np.zeros((len(pages), steps), bool)
    words = np.zeros((len(pages), steps, WORD_BUCKETS + PLAIN), np.float32)
    flat = word_vectors([leaf for page in pages for leaf in page])
    at = 0
    for r, page in enumerate(pages):
        index[r, :len(page)] = [known.setdefault(leaf.path, len(known)) for leaf in page]
        mask[r, :len(page)] = True
        words[r, :len(page)] = flat[at:at + len(page)]
        at += len(page)
    paths = np.zeros((len(known), PATH_BUCKETS), np.float32)
    for path, i in known.items():
        paths[i] = _path_vector(path)
    return paths, index, words, mask


def probabilities(model: Labeller, pages: list[list[Leaf]]) -> list[np.ndarray]:
    """Probability of main text for every leaf, pages of similar length together."""
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if pages[i]]
    at = 0
    while at < len(order):
        group = [order[at]]
        while at + len(group) < len(order) and (len(group) + 1) * len(pages[order[at + len(group)]]) <= 20_000 and len(group) < 256:
            group.append(order[at + len(group)])
        at += len(group)
        paths, index, words, mask = _padded([pages[i] for i in group])
        states = []
        for d in "fb":
            projected = paths @ model.weights[f"{d}_path"]
            gates = projected[index] + words @ model.weights[f"{d}_word"] + model.weights[f"{d}_bias"]
            states.append(model.run(d, gates, mask)[0])
        z = np.concatenate(states, axis=2) @ model.weights["out"] + model.weights["out_bias"]
        for r, i in enumerate(group):
            out[i] = 1 / (1 + np.exp(-z[r, :len(pages[i])]))
    return out


def train(pages: list[list[Leaf]], labels: list[np.ndarray], rounds: int = 14, window: int = 64, seed: int = 5) -> Labeller:
    """Adam on windows of ``window`` leaves, in batches of 32."""
    model = Labeller()
    model.start(seed)
    examples = [(page[i:i + window], label[i:i + window]) for page, label in zip(pages, labels) for i in range(0, len(page), window)]
    random, step = np.random.default_rng(seed), 0
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for _ in range(rounds):
        order = random.permutation(len(examples))
        for start in range(0, len(order), 32):
            chosen = [examples[i] for i in order[start:start + 32]]
            step += 1
            slopes = _slopes(model, chosen)
            for name, slope in slopes.items():
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.999 * second[name] + 0.001 * slope ** 2
                move = first[name] / (1 - 0.9 ** step) / (np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8)
                model.weights[name] = (model.weights[name] - 0.01 * move).astype(np.float32)
    return model


def _slopes(model: Labeller, chosen: list[tuple[list[Leaf], np.ndarray]]) -> dict[str, np.ndarray]:
    paths, index, words, mask = _padded([page for page, _ in chosen])
    target = np.zeros(mask.shape, np.float32)
    for r, (_, label) in enumerate(chosen):
        target[r, :len(label)] = label
    runs, states = {}, []
    for d in "fb":
        gates = (paths @ model.weights[f"{d}_path"])[index] + words @ model.weights[f"{d}_word"] + model.weights[f"{d}_bias"]
        out, runs[d] = model.run(d, gates, mask, keep=True)
        states.append(out)
    both = np.concatenate(states, axis=2)
    error = (1 / (1 + np.exp(-(both @ model.weights["out"] + model.weights["out_bias"]))) - target) * mask / mask.sum()
    slopes = {"out": np.einsum("bt,bth->h", error, both), "out_bias": np.array([error.sum()], np.float32)}
    d_both = error[:, :, None] * model.weights["out"]
    for k, d in enumerate("fb"):
        d_gates, slopes[f"{d}_state"] = model.back(d, runs[d], d_both[:, :, k * model.hidden:(k + 1) * model.hidden])
        flat = d_gates.reshape(-1, d_gates.shape[2])
        by_path = np.zeros((len(paths), flat.shape[1]), np.float32)
        np.add.at(by_path, index.reshape(-1), flat)
        slopes[f"{d}_path"] = paths.T @ by_path
        slopes[f"{d}_word"] = words.reshape(-1, words.shape[2]).T @ flat
        slopes[f"{d}_bias"] = flat.sum(axis=0)
    return slopes


# ---------------------------------------------------------------- training pages

# Names that templates give to parts of a page (fixed values).
_SIDE_NAMES = {
    "ad": ["ad", "ads", "advert", "banner", "promo", "sponsored"], "notice": ["cookie", "notice", "consent", "alert", "gdpr"],
    "side": ["sidebar", "related", "widget", "share", "social"], "comments": ["comments", "comment", "replies", "discussion"],
    "menu": ["menu", "navbar", "breadcrumbs", "toolbar"], "foot": ["footer", "copyright", "legal"],
}
_MAIN_NAMES = ["content", "post", "entry", "story", "article-body", "main", "text"]


def template_page(random: np.random.Generator, lines: list[str]) -> str:
    """A page in a random template; its main part carries the attribute ``data-main``."""
    def pick(values):
        return values[int(random.integers(len(values)))]

    def line(short: bool = False) -> str:
        text = html_module.escape(pick(lines), quote=False)
        return " ".join(text.split()[: int(random.integers(1, 6))]) if short else text

    def some(low, high, make):
        return "".join(make() for _ in range(int(random.integers(low, high))))

    def menu() -> str:
        tag = pick(["nav", f'div class="{pick(_SIDE_NAMES["menu"])}"'])
        items = some(2, 9, lambda: f'<li><a href="/x">{line(True)}</a></li>')
        return f"<{tag}><ul>{items}</ul></{tag.split()[0]}>"

    def box(kind: str) -> str:
        tag = pick(["div", "section", "aside"] if kind in ("side", "comments") else ["div", "p", "aside"])
        inner = line() if tag == "p" else pick([line(), some(1, 4, lambda: f"<p>{line()}</p>"), f"<h3>{line(True)}</h3><p>{line()}</p>"])
        return f'<{tag} {pick(["class", "id"])}="{pick(_SIDE_NAMES[kind])}">{inner}</{tag}>'

    def form() -> str:
        return f'<form><label>{line(True)}</label><input name="q"><button>{line(True)}</button></form>'

    def main_part() -> str:
        def block() -> str:
            tag = pick(["p", "p", "p", "p", "p", "h2", "blockquote", "li", "pre", "div"])
            text = line(tag == "h2")
            text = f"<b>{text}<br>" if random.random() < 0.1 else text
            return f"<ul><li>{text}</li></ul>" if tag == "li" else f"<{tag}>{text}</{tag}>"

        out = f"<h1>{line(True)}</h1>" if random.random() < 0.8 else ""
        return out + some(1, 14, block)

    before = "".join(part for chance, part in (
        (0.4, f'<header><div class="logo">{line(True)}</div><p>{line(True)}</p></header>'), (0.8, menu()),
        (0.3, box("notice")), (0.5, box("ad")), (0.2, form()), (0.2, box("side"))) if random.random() < chance)
    tag = pick(["article", "main", f'div class="{pick(_MAIN_NAMES)}"', f'div id="{pick(_MAIN_NAMES)}"', "section"])
    inside = main_part() + (f"</{tag.split()[0]}>{box('ad')}<{tag} data-main=\"main\">{main_part()}" if random.random() < 0.2 else "")
    after = "".join(part for chance, part in (
        (0.4, box("side")), (0.4, box("comments")), (0.2, box("ad")), (0.2, form()), (0.2, menu()),
        (0.2, box("foot")), (0.7, f"<footer>&copy; {line()}</footer>")) if random.random() < chance)
    return f'<html><head><title>{line(True)}</title></head><body>{before}<{tag} data-main="main">{inside}</{tag.split()[0]}>{after}</body></html>'


def labels_from(page: list[Leaf], document: str) -> np.ndarray | None:
    """1 for the leaves found in the page's document; None if too few of the page's text is."""
    flat = " ".join(document.split())
    lines = {" ".join(line.split()) for line in document.split("\n")}
    found = np.array([leaf.text in lines or (len(leaf.text) >= 30 and leaf.text in flat) for leaf in page], np.float32)
    size = np.array([len(leaf.text) for leaf in page])
    return found if len(page) and (found * size).sum() >= 0.5 * size.sum() else None


def fit(
    pages: DataFrame, docs: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    doc_id: str = "doc_id", text: str = "text", max_pages: int = 240, max_page_chars: int = 40_000,
) -> Labeller:
    """A labeller trained on ``max_pages`` pages at most, each shorter than ``max_page_chars``; all choices by
    hash, seeded. (The bounds are those of the training sample; every page is extracted whole.)

    A page's document is the one whose doc_id is the last number of its url's path. The pages are chosen by
    their ids alone; of a page_id or doc_id in several rows the least text is taken, so that its
    copies take no other one's place.
    """
    rows_of = pages.select(F.col(f"`{page_id}`").alias("_page"), F.col(f"`{url}`").alias("_url"), F.col(f"`{html}`").alias("_html")).where(
        F.col("_page").isNotNull() & (F.length("_html") > 0) & (F.length("_html") < max_page_chars))
    chosen = [r["_page"] for r in rows_of.select("_page").distinct().orderBy(F.xxhash64("_page"), "_page").limit(max_pages).collect()]
    rows = rows_of.where(F.col("_page").isin(chosen)).groupBy("_page").agg(F.min(F.struct("_html", "_url")).alias("_row")).select(
        "_page", "_row._html",
        F.expr(r"try_cast(regexp_extract(split(_row._url, '[?#]')[0], '([0-9]+)[^0-9]*$', 1) as bigint)").alias("_doc")).collect() if chosen else []
    wanted = sorted({r["_doc"] for r in rows if r["_doc"] is not None})
    texts_of = {} if not wanted else {
        r["_id"]: r["_text"] or "" for r in docs.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text"))
        .where(F.col("_id").isin(wanted)).groupBy("_id").agg(F.min("_text").alias("_text")).collect()}
    known, labels = [], []
    for row in sorted(rows, key=lambda r: (str(r["_page"]), r["_html"])):
        page = leaves(row["_html"])
        label = labels_from(page, texts_of.get(row["_doc"], ""))
        if label is not None:
            known.append(page)
            labels.append(label)
    lines = sorted({" ".join(line.split()) for t in texts_of.values() for line in t.split("\n") if line.strip()})
    lines = lines or ["One plain line of running text for a page.", "Another line, a little longer than the first one."]
    random = np.random.default_rng(11)
    for _ in range(max_pages):
        page = leaves(template_page(random, lines))
        known.append([Leaf(tuple(t for t in leaf.path if not t.startswith("data-main")), leaf.text, leaf.link_share, leaf.marked) for leaf in page])
        labels.append(np.array([leaf.marked for leaf in page], np.float32))
    return train([p for p in known if p], [label for p, label in zip(known, labels) if p])


def extract(
    pages: DataFrame, model: Labeller, page_id: str = "page_id", url: str = "url", html: str = "html", threshold: float = 0.5,
) -> DataFrame:
    """``page_id, url, text, n_chars``: the main blocks of every page, joined by two line feeds."""
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("_html"))
    id_type = rows.schema["page_id"].dataType.simpleString()
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_html"):
            of_pages = [leaves(h) for h in texts(part, "_html")]
            found = [
                "\n\n".join(leaf.text for leaf, p in zip(page, chance) if p >= threshold)
                for page, chance in zip(of_pages, probabilities(sent.value, of_pages))]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(extracted, f"page_id {id_type}, url string, text string, n_chars long")
