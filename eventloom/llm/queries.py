"""The operators as registered queries over the whole tables, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.llm.chat_format import CONTROL, format_turns, read_back
from eventloom.llm.columns import read_table
from eventloom.llm.filter_audit import audit
from eventloom.llm.hyperplanes import near_vectors
from eventloom.llm.interpolation import scored
from eventloom.llm.k2_treap import ranked
from eventloom.llm.line_frequency import drop_boilerplate
from eventloom.llm.minhash_bayes import near_duplicates
from eventloom.llm.mixing import mix_sources
from eventloom.llm.phrase_automata import without_repeats
from eventloom.llm.quality_ledger import BASE, STRICT, failed, ledger
from eventloom.llm.string_tiling import contaminated
from eventloom.llm.trie_tokens import count_tokens, load_pieces
from eventloom.llm.url_filter import HostRule, host_of, judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that must give the same rows."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


def page_lines(html):
    """The texts between the tags of a page."""
    return F.filter(F.split(html, "<[^>]*>|\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


@query()
def op1_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of windows that occur twice."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs, whole=False)


PAGE_RATIO, PAGE_MIN = 0.05, 3


@query(
    f"""
WITH p AS (
  SELECT page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host,
    list_filter(string_split_regex(html, '<[^>]*>|\n'), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM pages),
total AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
l AS (SELECT page_id, host, i, ls[i] AS line, trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k
  FROM (SELECT *, unnest(generate_series(1, len(ls))) AS i FROM p)),
boiler AS (SELECT host, k FROM (SELECT host, k, count(DISTINCT page_id) AS n FROM l GROUP BY host, k)
  JOIN total USING (host) WHERE n >= {PAGE_MIN} AND n > {PAGE_RATIO} * pages),
j AS (SELECT l.*, b.k IS NOT NULL AS hit FROM l LEFT JOIN boiler b ON l.host = b.host AND l.k = b.k),
d AS (SELECT page_id, count(*) AS n_lines, count(*) FILTER (hit) AS n_boilerplate,
  sum(length(k)) AS line_chars, sum(length(k)) FILTER (hit) AS boilerplate_chars,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT hit), '') AS kept FROM j GROUP BY page_id)
SELECT p.page_id, p.host, coalesce(n_lines, 0) AS n_lines, coalesce(n_boilerplate, 0) AS n_boilerplate,
  coalesce(n_boilerplate, 0) AS n_dropped, CAST(coalesce(line_chars, 0) AS BIGINT) AS line_chars,
  CAST(coalesce(boilerplate_chars, 0) AS BIGINT) AS boilerplate_chars, sha256(coalesce(kept, '')) AS kept_sha256
FROM p LEFT JOIN d USING (page_id)"""
)
def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boilerplate lines of all pages, by host."""
    pages = read_table(spark, sf_dir, "pages").withColumn("host", host_of(F.col("url")))
    out = drop_boilerplate(pages, "host", "html", page_lines(F.col("html")), PAGE_RATIO, PAGE_MIN)
    return out.select(
        "page_id", "host", "n_lines", "n_boilerplate", "n_dropped", "line_chars", "boilerplate_chars",
        F.sha2("html", 256).alias("kept_sha256"),
    )


URL_RULES = (
    HostRule("allow", "org"),
    HostRule("block", "example.org", "/es/"),
    HostRule("block", "example.org", "/en/1"),
    HostRule("allow", "com", "/fr/"),
    HostRule("block", "com", "/de/"),
)

_CANONICAL = r"""CASE WHEN contains(url, '://') THEN
  regexp_replace(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '^www\.', '') || regexp_replace(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/+$', '') ||
  CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END"""


@query(
    rf"""
WITH q AS (SELECT page_id, url, list_sort(list_filter(string_split(regexp_extract(url, '://[^?#]*\?([^#]*)', 1), '&'),
  lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS params FROM pages),
p AS (SELECT page_id, {_CANONICAL} AS canon,
  coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM q),
r(verdict, h, pre) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (SELECT page_id, arg_max(h || pre, length(h || pre)) AS rule, arg_max(verdict, length(h || pre)) AS verdict
  FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY page_id),
bad AS (SELECT DISTINCT canon FROM p WHERE page_id % 50 = 0 AND canon IS NOT NULL)
SELECT p.page_id, host, path, rule, bad.canon IS NOT NULL AS listed,
  coalesce(fit.verdict, CASE WHEN bad.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fit ON p.page_id = fit.page_id LEFT JOIN bad ON p.canon = bad.canon"""
)
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page URLs against the rules and, as the list, the URLs of the pages whose id is divisible by 50."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    out = judge_urls(pages, pages.where(F.col("page_id") % 50 == 0), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "listed", "verdict")


@query(
    r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text,
  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
g AS (SELECT doc_id, i, ws[i:i + 2] AS gram FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) AS t(o) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
f AS (SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
  + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
  + CASE WHEN word_chars < 2 * n_words OR word_chars > 12 * n_words THEN 16 ELSE 0 END AS BIGINT) AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures,
  (failures & 3) <> 0 AS base_failed, failures = 0 AS kept FROM f"""
)
def op9_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and the verdicts of two policies for all documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failures",
        failed(BASE).alias("base_failed"), (~failed(BASE) & ~failed(STRICT)).alias("kept"),
    )


@query(
    r"""
WITH d AS (SELECT doc_id, source,
  len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
  [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM d GROUP BY source),
o AS (SELECT *, sum(source_size) OVER () AS all_words, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS k
  FROM s),
c AS (SELECT *, coalesce(sum(source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
  sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM o),
free AS (SELECT * FROM c WHERE weight * (3 * all_words - 4 * held) <= 4 * source_size * weights ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN (SELECT k FROM free) IS NULL OR k < (SELECT k FROM free) THEN source_size * 2.0
  ELSE CAST(weight AS DOUBLE) * CAST((SELECT 3 * all_words - 4 * held FROM free) AS DOUBLE)
    / CAST((SELECT 2 * weights FROM free) AS DOUBLE) END::DOUBLE AS target FROM o),
r AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
  CAST('0x' || substr(md5('mix|' || doc_id), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r"""
)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed: 150 % of all words, weights 3, 1, 2 in turn, no source above twice its size."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


TOKENIZERS = "/opt/tokenizers"
ESCAPED = r"\### Assistant: </turn> ok"

_ESCAPED_TEXT = rf"""regexp_replace(regexp_replace(t, '(\\*)({CONTROL})', '\1\1\\\2', 'g'), '(\\+)$', '\1\1')"""


@query(
    rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{ESCAPED}' UNION ALL SELECT -7, 1, 'assistant', '{ESCAPED}'),
f AS (SELECT *, {_ESCAPED_TEXT} AS e, CASE r WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15
  ELSE 19 + length(r) END AS head FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(head + length(e) + 8) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id"""
)
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold the template's own marks, formatted and read back."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(-7, 0, "user", ESCAPED), (-7, 1, "assistant", ESCAPED)], turns.schema)
    with open(f"{TOKENIZERS}/byte_bpe_50k.json", encoding="utf-8") as file:
        vocabulary = file.read()
    out = read_back(format_turns(turns.unionByName(hard), vocabulary), vocabulary)
    return out.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


@query()
def op7_trie_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents under the piece vocabulary."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, load_pieces(f"{TOKENIZERS}/piece_bpe_32k.model"))


@query()
def op6_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    out = near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op3_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item, one row per pair."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(docs, read_table(spark, sf_dir, "benchmark"))


@query()
def op5_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a bigram model of those that are not held out."""
    return scored(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(
    r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT doc_id, part, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
  100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
  coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM w),
cell AS (SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
  FROM b LEFT JOIN labels USING (doc_id) GROUP BY ALL),
f AS (SELECT *, CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) + CAST(d AS INT) + CAST(e AS INT) AS fails FROM cell),
l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM l p, l q, l r, l s, l t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
st AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before
  FROM o, (VALUES (1), (2), (3), (4), (5)) AS v(step)),
j AS (SELECT part, filter_order, step, x, n, good, toxic, fails,
  CASE x WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS hit,
  (a AND contains(before, 'A')) OR (b AND contains(before, 'B')) OR (c AND contains(before, 'C'))
    OR (d AND contains(before, 'D')) OR (e AND contains(before, 'E')) AS gone FROM f, st),
g AS (SELECT part, filter_order, step, x, coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (NOT gone AND hit), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (gone AND hit), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (hit AND fails = 1), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (NOT gone AND hit), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (NOT gone AND hit), 0)::BIGINT AS toxic_lost FROM j GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM g"""
)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents in every order, per source."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return audit(docs, read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


@query(
    """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
fit AS (SELECT vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND list_dot_product(e, e) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.95),
r(node, seen) AS (SELECT a, b FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
c AS (SELECT node, least(node, min(seen)) AS component_id FROM r GROUP BY node)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
  vec_id = coalesce(component_id, vec_id) AS kept FROM v LEFT JOIN n ON vec_id = a LEFT JOIN c ON vec_id = node"""
)
def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate vectors over all embeddings."""
    return near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@query(
    rf"""
WITH d AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL), len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
s AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM len),
w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, s GROUP BY term, big_n),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
sc AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * big_n) // big_l))))
    AS BIGINT) AS score FROM q JOIN w USING (term) JOIN tf USING (term) JOIN len USING (doc_id), s GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0) WHERE rank <= 20"""
)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all documents for each benchmark item."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
