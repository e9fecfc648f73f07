"""Quality rules as a short-circuit cascade, in SQL functions only.

Each rule is a condition under which a text fails. Before the corpus is judged, every rule's cost
(seconds per sampled row) and rejection rate are measured on a bounded sample; the rules then
stand in the order of rejections per second. A row stops at the first rule that it fails, as the
cascade is one CASE expression and Spark evaluates a branch only when those above it are false.
The order changes the work, never the verdict.

Defined results: a null or empty text has no words and fails ``few_words``; repeated rows are
judged alike; an empty table gives an empty table; a text of any length is read whole; other
columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.sinks.files import store

_SPACE = r"[\x20\x09-\x0D]+"
_SPACE_CHARS = " \t\n\x0b\f\r"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE_CHARS))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, _SPACE))


def word_chars(of_words: Column) -> Column:
    return F.length(F.array_join(of_words, "")).cast("long")


def symbol_count(text: Column) -> Column:
    """Characters of ``[#*$%&|<>]``."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("long")


def capital_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\p{Lu}")), F.lit(0)).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines (split at ``\\n``) with a word that equal an earlier line of the text."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    with_word = F.filter(lines, lambda line: F.length(F.btrim(line, F.lit(_SPACE_CHARS))) > 0)
    return _let(with_word, lambda kept: F.size(kept) - F.size(F.array_distinct(kept))).cast("long")


def repeated_window_words(of_words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text, the first included.

    Windows are compared by 64-bit hashes. Equal ones are brought together by sorting the hashes
    with the window's position in their low bits, so the cost is n log n for any text.
    """
    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(h: Column) -> Column:
        low = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(F.size(h).cast("long")))) - 1
        packed = F.sort_array(F.transform(
            h, lambda x, i: x.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))))
        return _let(packed, lambda s: _let(low, lambda mask: _covered_words(h, s, mask)))

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))

    return F.when(F.size(of_words) < 4, F.lit(0)).otherwise(
        _let(of_words, lambda w: _let(windows(w), counted))).cast("long")


def _covered_words(h: Column, s: Column, mask: Column) -> Column:
    """Words under the windows whose hash occurs again; ``s``: hashes with positions, sorted."""
    def position(k: Column) -> Column:
        return F.get(s, k).bitwiseAND(mask).cast("int")

    def again(k: Column) -> Column:
        other = lambda j: F.coalesce(F.get(h, position(j)) == F.get(h, position(k)), F.lit(False))
        return (F.when(k > 0, other(k - 1)).otherwise(F.lit(False))) | other(k + 1)

    found = F.filter(F.sequence(F.lit(0), F.size(s) - 1), again)
    places = F.sort_array(F.transform(found, position))
    return _let(places, lambda p: F.when(F.size(p) == 0, F.lit(0)).otherwise(
        F.lit(3) + F.aggregate(
            F.sequence(F.lit(0), F.size(p) - 1), F.lit(0),
            lambda total, k: total + F.when(k == 0, F.lit(0)).otherwise(
                F.least(F.lit(3), F.get(p, k) - F.get(p, k - 1))))))


@dataclass(frozen=True)
class Rule:
    """A named condition, built from the text and its words, under which a text is rejected."""
    name: str
    fails: Callable[[Column, Column], Column]


def base_rules(min_words: int = 50, max_repeat_percent: int = 50) -> list[Rule]:
    return [
        Rule("few_words", lambda text, w: F.size(w) < min_words),
        Rule("repeated_windows",
             lambda text, w: 100 * repeated_window_words(w) > max_repeat_percent * F.size(w)),
    ]


def default_rules(
    max_symbols_per_100_words: int = 30,
    max_repeated_line_percent: int = 50,
    max_capital_percent: int = 60,
    word_length: tuple[float, float] = (1.5, 20.0),
) -> list[Rule]:
    """The base rules and limits that running prose stays far away from."""
    def line_count(text: Column) -> Column:
        return F.size(F.split(F.coalesce(text, F.lit("")), "\n", -1))

    return base_rules() + [
        Rule("symbols",
             lambda text, w: 100 * symbol_count(text) > max_symbols_per_100_words * F.size(w)),
        Rule("repeated_lines",
             lambda text, w: 100 * repeated_lines(text) > max_repeated_line_percent * line_count(text)),
        Rule("capitals",
             lambda text, w: 100 * capital_count(text) > max_capital_percent * word_chars(w)),
        Rule("word_length",
             lambda text, w: (word_chars(w) < word_length[0] * F.size(w))
             | (word_chars(w) > word_length[1] * F.size(w))),
    ]


def order_rules(docs: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = 1000, runs: int = 2) -> list[Rule]:
    """The rules by rejections per second, measured on a sample of about ``sample_rows`` rows.

    The sample is a hash sample of the whole table with an upper bound, stored once.
    Each rule is timed alone on it: the least of ``runs`` after one to warm up, less that of a rule that
    only cuts the words. Only the order depends on it, so a bound is harmless.
    """
    total = docs.count()
    share = max(1, total // sample_rows)
    sample = store(
        docs.select(F.col(f"`{text}`").alias("_text"))
        .where(F.pmod(F.xxhash64(F.substring("_text", 1, 64)), F.lit(share)) == 0).limit(2 * sample_rows),
        "rule-sample")

    def timed(fails: Callable[[Column, Column], Column]) -> tuple[float, int]:
        counted = sample.select(words(F.col("_text")).alias("_words"), "_text").agg(F.count_if(fails(F.col("_text"), F.col("_words"))))
        failed, taken = counted.first()[0], []
        for _ in range(runs):
            started = time.perf_counter()
            counted.collect()
            taken.append(time.perf_counter() - started)
        return min(taken), failed

    idle, _ = timed(lambda text, w: F.size(w) < 0)
    measured = []
    for rule in rules:
        seconds, failed = timed(rule.fails)
        measured.append((failed / max(seconds - idle, 1e-3), rule))
    return [rule for _, rule in sorted(measured, key=lambda pair: -pair[0])]


def cascade(text: Column, of_words: Column, rules: list[Rule]) -> Column:
    """The name of the first rule that a text fails, null if it passes all."""
    branches = None
    for rule in rules:
        fails = F.coalesce(rule.fails(text, of_words), F.lit(False))
        branches = F.when(fails, rule.name) if branches is None else branches.when(fails, rule.name)
    return branches if branches is not None else F.lit(None).cast("string")


def keep_passing(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """The rows that pass every rule, with their own columns."""
    rules = order_rules(docs, default_rules() if rules is None else rules, text)
    content = F.col(f"`{text}`")
    return docs.where(_let(words(content), lambda w: cascade(content, w, rules)).isNull())


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """Base counts and verdict per row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept``. ``kept`` is the cascade's verdict over all rules."""
    rules = order_rules(docs, default_rules() if rules is None else rules, text)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    rows = rows.withColumn("_words", words(F.col("_text")))
    rows = rows.select(
        "doc_id", "_text", "_words",
        F.size("_words").cast("long").alias("n_words"),
        word_chars(F.col("_words")).alias("word_chars"),
        symbol_count(F.col("_text")).alias("n_symbols"),
        repeated_lines(F.col("_text")).alias("n_dup_lines"),
        repeated_window_words(F.col("_words")).alias("n_repeat_words"),
    )
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rest = [rule for rule in rules if rule.name not in ("few_words", "repeated_windows")]
    failed = F.when(base_failed, "base").otherwise(cascade(F.col("_text"), F.col("_words"), rest))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), failed.isNull().alias("kept"))
