"""The queries over the text tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tripweave.llm import (
    bpe, exact_dedup, html_text, katz, language_id, merkle, packing, phrases, quality_classifier, quality_rules, sharding,
    shingle_join, url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


URL_RULES = [
    url_filter.Rule("net/", "block"), url_filter.Rule("example.net/en/", "allow"),
    url_filter.Rule("example.com/de/", "block"), url_filter.Rule("org/fr/", "allow"),
]


@query()
def op1_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    labelled = url_filter.SEED_URLS + url_filter.labelled_by_documents(pages, table(spark, sf_dir, "labels"))
    threshold = url_filter.blocking_threshold(labelled)
    return url_filter.judge(pages, url_filter.fit(labelled), URL_RULES, threshold=threshold)


@query()
def op2_best_fit_packing(spark, sf_dir):
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return packing.pack(pieces)


@query()
def op3_hypergeometric_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).cast("long").alias("text_crc32"))
    return sharding.shard_rows(docs, n_shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query(r"""
    with recursive d as (
        select row_number() over () as id, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
    u as (select id, unnest(w) as w, unnest(range(len(w))) as i from d where len(w) >= 5),
    five as (
        select id, w || ' ' || lead(w) over s || ' ' || lead(w, 2) over s || ' ' || lead(w, 3) over s || ' ' || lead(w, 4) over s as s
        from u window s as (partition by id order by i)),
    shingle as (
        select distinct id, s from five where s is not null
        union all select id, array_to_string(w, ' ') from d where len(w) between 1 and 4),
    size as (select id, count(*) as n from shingle group by id),
    common as (select a.id as a, b.id as b, count(*) as c from shingle a join shingle b on a.s = b.s and a.id < b.id group by all),
    link as (
        select a, b from common join size x on x.id = a join size y on y.id = b where 100 * c >= 75 * (x.n + y.n - c)),
    both_ as (select a, b from link union all select b, a from link),
    reach(id, other) as (select id, id from d union select r.id, k.b from reach r join both_ k on k.a = r.other),
    least as (select r.id, min(o.doc_id) as component_id from reach r join d o on o.id = r.other group by r.id)
    select d.doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, component_id
    from d join least l on l.id = d.id left join size s on s.id = d.id""")
def op4_shingle_join(spark, sf_dir):
    return shingle_join.find_groups(table(spark, sf_dir, "documents"))


@query(r"""
    with d as (
        select row_number() over () as id, doc_id, coalesce(text, '') as t,
            list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
    u as (select id, unnest(w) as w, unnest(range(len(w))) as i from d),
    three as (
        select id, i, w || ' ' || lead(w) over s || ' ' || lead(w, 2) over s as s from u window s as (partition by id order by i)),
    again as (select id, i from three where s is not null qualify count(*) over (partition by id, s) > 1),
    repeat_ as (select id, count(distinct j) as n from (select id, unnest([i, i + 1, i + 2]) as j from again) group by id),
    line as (select id, unnest(string_split(t, chr(10))) as line from d),
    lines as (
        select id, count(*) as n_lines, count(*) filter (where regexp_matches(line, '[^\x20\x09-\x0D]'))
            - count(distinct line) filter (where regexp_matches(line, '[^\x20\x09-\x0D]')) as n_dup from line group by id),
    c as (
        select doc_id, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as word_chars,
            len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, n_dup as n_dup_lines, coalesce(r.n, 0) as n_repeat_words,
            n_lines, len(regexp_extract_all(t, '\p{Lu}')) as capitals
        from d join lines l on l.id = d.id left join repeat_ r on r.id = d.id),
    b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c)
    select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
        cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
        not base_failed and 100 * n_symbols <= 30 * n_words and 100 * n_dup_lines <= 50 * n_lines and 100 * capitals <= 60 * word_chars
            and word_chars >= 1.5 * n_words and word_chars <= 20 * n_words as kept
    from b""")
def op5_quality_cascade(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query(r"""
    with d as (select doc_id, coalesce(text, '') as t from documents),
    g as (select t, max(doc_id) as keep_id, count(*) as n from d group by t)
    select d.doc_id, g.keep_id, cast(g.n as bigint) as group_size, d.doc_id = g.keep_id as kept,
        sha256(d.t) as text_sha256
    from d join g on d.t = g.t""")
def op6_radix_dedup(spark, sf_dir):
    return exact_dedup.find_copies(table(spark, sf_dir, "documents"))


def id_remainder(divisor: int):
    """crc32 of doc_id as text, modulo ``divisor``; -1 for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor, F.lit(-1))


@query()
def op7_zstd_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(id_remainder(4) != 2))
    return language_id.predict(docs, model).select(
        "doc_id", (id_remainder(4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query()
def op8_lsa_neighbours(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels.where(id_remainder(5) > 0))
    return docs.withColumn("score", quality_classifier.score_column(docs, model)).select(
        "doc_id", (id_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query()
def op9_bpe_tree(spark, sf_dir):
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query()
def op10_html_blocks(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages, table(spark, sf_dir, "documents")))


@query(r"""
    with recursive crc as (
        select list(list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) order by k) as t
        from range(256) r(k)),
    d as (
        select doc_id, source, sha256(f || case when text is null then '-' else strlen(text) || ':' || text end) as leaf,
            case when xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
                    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 5 = 0
                then sha256(f || case when text is null then '-' else strlen(text) || ':' ||
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') end) end as changed
        from (select *, (case when doc_id is null then '-' else strlen(cast(doc_id as varchar)) || ':' || doc_id end)
                || (case when source is null then '-' else strlen(source) || ':' || source end)
                || (case when lang is null then '-' else strlen(lang) || ':' || lang end)
                || (case when n_chars is null then '-' else strlen(cast(n_chars as varchar)) || ':' || n_chars end) as f from documents), crc),
    placed as (
        select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by source) as n from d),
    up(source, lvl, pos, node, n) as (
        select source, 0, pos, leaf, n from placed
        union all
        select source, lvl + 1, pos // 16, sha256(string_agg(node, '' order by pos)), (any_value(n) + 15) // 16
        from up where n > 1 group by source, lvl, pos // 16),
    sub as (
        select source, lvl, node, row_number() over (order by source nulls first) - 1 as pos, count(*) over () as n from up where n = 1),
    top(lvl, pos, node, n) as (
        select 0, pos, node, n from sub
        union all
        select lvl + 1, pos // 16, sha256(string_agg(node, '' order by pos)), (any_value(n) + 15) // 16 from top where n > 1 group by lvl, pos // 16),
    tree as (
        select source, lvl, pos, node, n from up where n > 1
        union all
        select s.source, s.lvl + t.lvl, t.pos, t.node, t.n from sub s, top t where t.n > 1),
    step(doc_id, leaf, source, lvl, pos, node, siblings) as (
        select doc_id, leaf, source, 0, pos, coalesce(changed, leaf), '' from placed
        union all
        select f.doc_id, f.leaf, f.source, f.lvl + 1, f.pos // 16,
            sha256(string_agg(case when t.pos = f.pos then f.node else t.node end, '' order by t.pos)),
            any_value(f.siblings) || coalesce(string_agg(case when t.pos <> f.pos then t.node end, '' order by t.pos), '')
        from (select p.doc_id, p.leaf, p.source, p.lvl, case when p.lvl = z.lvl then z.pos else p.pos end as pos, p.node, p.siblings
              from step p join sub z on z.source is not distinct from p.source) f
        join sub s on s.source is not distinct from f.source
        join tree t on t.source is not distinct from f.source and t.lvl = f.lvl and t.pos // 16 = f.pos // 16
        group by f.doc_id, f.leaf, f.source, f.lvl, f.pos),
    last as (select doc_id, source, leaf, max_by(node, lvl) as node, max_by(siblings, lvl) as siblings from step group by all)
    select l.doc_id, l.leaf, s.node as subroot, r.node as root, sha256(l.siblings) as proof_sha256, l.node as folded_root, l.node = r.node as verified
    from last l join sub s on s.source is not distinct from l.source, (select node from top where n = 1) r""")
def op11_merkle_manifest(spark, sf_dir):
    return merkle.verify(table(spark, sf_dir, "documents"), F.coalesce(id_remainder(5) == 0, F.lit(False)))


@query(r"""
    with t as (
        select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) as piece from documents),
    v as (select row_number() over () as id, lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as v from t),
    w as (select id, lang, unnest(v) as p1, unnest(range(len(v))) as i from v),
    p as (
        select lang, p1, p1 || ' ' || lead(p1) over s as p2, p1 || ' ' || lead(p1) over s || ' ' || lead(p1, 2) over s as p3,
            p1 || ' ' || lead(p1) over s || ' ' || lead(p1, 2) over s || ' ' || lead(p1, 3) over s as p4
        from w window s as (partition by id order by i)),
    g as (
        select lang, 1 as k, p1 as phrase from p union all select lang, 2, p2 from p where p2 is not null
        union all select lang, 3, p3 from p where p3 is not null union all select lang, 4, p4 from p where p4 is not null),
    f as (select lang, k, phrase, count(*) as f from g group by all having count(*) >= 30),
    total as (select lang, count(*) as n from w group by lang),
    c as (select lang, k, phrase, f as a, string_split(phrase, ' ') as v from f where k > 1),
    cut as (
        select c.lang, c.phrase, c.a, c.k, i, l.f as l, r.f as r, cast(2000000 * cast(a as hugeint) // (l.f + r.f) as bigint) as score
        from c, range(1, 4) s(i), f l, f r
        where i < c.k and l.lang = c.lang and l.phrase = array_to_string(v[1:i], ' ') and r.lang = c.lang and r.phrase = array_to_string(v[i + 1:], ' ')),
    best as (select * from cut qualify row_number() over (partition by lang, phrase order by score, i) = 1),
    inner_ as (
        select lang, array_to_string(v[i:i + n - 1], ' ') as phrase, max(a) as longer
        from c, range(1, 4) s(i), range(2, 4) z(n) where n < k and i + n - 1 <= k group by all),
    kept as (
        select b.*, cast(row_number() over (partition by b.lang order by score desc, a desc, encode(b.phrase)) as bigint) as rank
        from best b left join inner_ n on n.lang = b.lang and n.phrase = b.phrase
        where n.longer is null or 100 * cast(n.longer as hugeint) < 80 * cast(a as hugeint))
    select kept.lang, rank, phrase, a, l, r, cast(n as bigint) as n, score from kept join total on total.lang = kept.lang where rank <= 2000""")
def op12_phrase_collocations(spark, sf_dir):
    return phrases.mine(table(spark, sf_dir, "documents"))


@query()
def op13_katz_scoring(spark, sf_dir):
    scored = katz.score(table(spark, sf_dir, "documents"), id_remainder(10) != 0)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
