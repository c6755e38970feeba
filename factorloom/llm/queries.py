"""The queries of this package, with production parameters over whole tables, and the SQL some must agree with."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import stored
from . import bpe, collocations, decon, html, jaccard, linededup, mixing, packing, quality, resampling, secrets, shards, urls
from .base import table

#: Host, path, action; fixed values.
URL_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]
RANKS = "byte_bpe_50k.tiktoken"


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    extra = quality.order_rules(docs, quality.RULES[len(quality.BASE) :])
    return quality.features(docs, extra=extra)


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urls.verdicts(table(spark, sf_dir, "pages"), rules)


def bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    coded = bpe.encode(table(spark, sf_dir, "documents"), path, pattern, offsets=True, decoded=True)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.xxhash64("starts", "ends").alias("offsets_xxhash64"),
    )


def packed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids in rows of 8192."""
    ids = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return packing.pack(stored(ids), length=8192, width=4, size_col="n_tokens")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decon.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, html.train(pages))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_deleted")


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_secret_scan": secret_scan,
    "op2_quality_rules": quality_rules,
    "op3_url_filter": url_filter,
    "op4_bpe_codec": bpe_codec,
    "op5_packed_rows": packed_rows,
    "op6_decontamination": decontamination,
    "op7_html_text": html_text,
    "op8_sharding": sharding,
    "op9_jaccard_join": jaccard_join,
    "op10_line_dedup": line_dedup,
    "op11_source_mix": source_mix,
    "op12_phrase_collocations": phrase_collocations,
    "op13_importance_resampling": importance_resampling,
}

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[ \x09-\x0D]+'), lambda w: w <> '')"

SQL = {
    "op2_quality_rules": rf"""
WITH a AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \x09-\x0D]')) AS l
  FROM documents
),
g AS (
  SELECT r, i, w[i : i + 7] AS g FROM a, unnest(range(1, CAST(len(w) AS BIGINT) - 6)) AS u(i)
),
d AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
c AS (
  SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM d) GROUP BY r
),
f AS (
  SELECT a.r, doc_id, text, w, l, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[ \x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM a LEFT JOIN c ON a.r = c.r
),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (
         10 * n_symbols > n_words
         OR 2 * len(list_filter(w, lambda x: lower(x) <> x AND upper(x) = x AND length(x) > 1)) > n_words
         OR 10 * len(list_filter(w, lambda x, i: i > 1 AND x = w[i - 1])) > 3 * n_words
         OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_dup_lines > 6 * len(l)
       ) AS kept
FROM b""",
    "op3_url_filter": r"""
WITH rules(h, p, action) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
         ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
),
a AS (
  SELECT row_number() OVER () AS r, page_id,
         CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
b AS (
  SELECT r, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM a
),
m AS (
  SELECT r, arg_max(row(h || p, action), length(h || p)) AS best
  FROM b JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r
)
SELECT page_id, host, path, best[1] AS rule, coalesce(best[2], 'allow') AS verdict FROM b LEFT JOIN m ON b.r = m.r""",
    # a run of four tokens is left however four of twenty change, or as many of fewer as are allowed
    "op6_decontamination": r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents
),
b AS (
  SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark
),
dg AS (SELECT doc_id, i, w[i : i + 3] AS g FROM d, unnest(range(1, CAST(len(w) AS BIGINT) - 2)) AS u(i)),
bg AS (SELECT item_id, i, w[i : i + 3] AS g FROM b, unnest(range(1, CAST(len(w) AS BIGINT) - 2)) AS u(i)),
diag AS (SELECT DISTINCT doc_id, item_id, dg.i - bg.i AS shift FROM dg JOIN bg USING (g)),
runs AS (
  SELECT doc_id, item_id, shift, s, least(20, len(b.w)) AS n,
         len(list_filter(range(s, s + least(20, len(b.w))), lambda k: k + shift >= 1 AND d.w[k + shift] = b.w[k])) AS matches
  FROM diag JOIN d USING (doc_id) JOIN b USING (item_id), unnest(range(1, greatest(2, CAST(len(b.w) AS BIGINT) - 18))) AS u(s)
),
best AS (
  SELECT doc_id, item_id, max(row(matches, -(s + shift - 1), -(s - 1))) AS x FROM runs
  WHERE matches >= n - CASE WHEN n >= 20 THEN 4 WHEN n >= 17 THEN 3 WHEN n >= 13 THEN 2 WHEN n >= 9 THEN 1 ELSE 0 END GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, CAST(x[1] AS INTEGER) AS matches, CAST(-x[2] AS INTEGER) AS doc_start, CAST(-x[3] AS INTEGER) AS item_start FROM best""",
    "op10_line_dedup": r"""
WITH t AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS all_lines FROM documents
),
l AS (
  SELECT doc_id, pos, all_lines[pos] AS line,
         len(list_filter(string_split_regex(all_lines[pos], '[ \x09-\x0D]+'), lambda w: w <> '')) AS n
  FROM t, unnest(range(1, CAST(len(all_lines) AS BIGINT) + 1)) AS u(pos)
  WHERE regexp_matches(all_lines[pos], '[^ \x09-\x0D]')
),
c AS (
  SELECT doc_id, pos, line, n, row_number() OVER w AS i, sum(n) OVER w - n AS before, sum(n) OVER w AS upto
  FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
),
f AS (
  SELECT doc_id, i AS s, count(*) OVER w AS m, sum(n) OVER w AS words, string_agg(line, chr(10)) OVER w AS run
  FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
),
g AS (
  SELECT doc_id, i - count(*) OVER w + 1 AS s, count(*) OVER w AS m, sum(n) OVER w AS words, string_agg(line, chr(10)) OVER w AS run
  FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
),
later AS (
  SELECT doc_id, s, m FROM (SELECT DISTINCT * FROM (FROM f UNION ALL FROM g) WHERE words >= 50)
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, s) > 1
),
gone AS (SELECT DISTINCT doc_id, i FROM later, unnest(range(s, s + m)) AS u(i)),
lost AS (SELECT doc_id, list(pos) AS lost FROM c JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id,
       CASE WHEN lost IS NULL THEN text ELSE
         array_to_string(list_filter(all_lines, lambda x, i: NOT list_contains(lost, i)), chr(10)) END AS text,
       coalesce(len(lost), 0) AS n_deleted
FROM t LEFT JOIN lost USING (doc_id)""",
    "op12_phrase_collocations": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM p),
g AS (
  SELECT lang, w[i : i + m - 1] AS g FROM w, unnest(range(1, 5)) AS s(m), unnest(range(1, CAST(len(w) AS BIGINT) - m + 2)) AS u(i)
),
f AS (SELECT lang, g, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
c AS (SELECT lang, g, f AS a FROM f WHERE f >= 30 AND len(g) > 1),
cuts AS (
  SELECT c.lang, c.g, a, k, x.f AS l, y.f AS r, CAST(2000000 * CAST(a AS HUGEINT) // (x.f + y.f) AS BIGINT) AS score
  FROM c, unnest(range(1, len(g))) AS u(k) JOIN f AS x ON x.lang = c.lang AND x.g = c.g[1 : k] JOIN f AS y ON y.lang = c.lang AND y.g = c.g[k + 1 :]
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (
  SELECT lang, g[i : i + m - 1] AS g, max(a) AS longer
  FROM c, unnest(range(2, len(g))) AS s(m), unnest(range(1, len(g) - m + 2)) AS u(i) GROUP BY ALL
),
kept AS (
  SELECT best.*, array_to_string(best.g, ' ') AS phrase FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.g = best.g
  WHERE longer IS NULL OR 100 * longer < 80 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000""",
    # a CRC is folded byte by byte over the table that the reversed polynomial gives
    "op13_importance_resampling": r"""
WITH t AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) ORDER BY b) AS t
  FROM range(256) AS r(b)
),
x AS (
  SELECT row_number() OVER () AS r, 0 AS aim, doc_id, text FROM documents UNION ALL SELECT NULL, 1, NULL, text FROM benchmark
),
w AS (
  SELECT r, aim, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM x
),
o AS (
  SELECT r, aim, unnest(list_concat(w, list_transform(w[2:], lambda x, i: w[i] || ' ' || x))) AS f FROM w
),
n AS (SELECT r, aim, f, count(*) AS n FROM o GROUP BY ALL),
h AS (
  SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, CAST(strlen(f) AS BIGINT)), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT))),
            lambda c, b: xor(t[xor(c % 256, b) + 1], c // 256))) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM n), t
),
c AS (
  SELECT bucket, CAST(sum(n) FILTER (aim = 0) AS DOUBLE) AS s, CAST(sum(n) FILTER (aim = 1) AS DOUBLE) AS t FROM n JOIN h USING (f) GROUP BY bucket
),
g AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (sum(coalesce(s, 0)) OVER () + 10000) / ((coalesce(s, 0) + 1) * (sum(coalesce(t, 0)) OVER () + 10000)))) AS BIGINT) AS gain
  FROM c
),
m AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * gain) AS BIGINT) AS gain FROM n JOIN h USING (f) JOIN g USING (bucket) WHERE aim = 0 GROUP BY r
),
d AS (
  SELECT w.r, doc_id, len(w) AS words, coalesce(m.n, 0) AS n_features,
         CASE WHEN m.n IS NULL THEN 0 ELSE (gain - ((gain % m.n) + m.n) % m.n) // m.n END AS weight,
         CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM w LEFT JOIN m ON m.r = w.r WHERE aim = 0
),
e AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM d
),
k AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n FROM e WHERE words >= 20
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank
FROM e LEFT JOIN k USING (r)""",
}
