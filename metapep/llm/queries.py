"""The queries of this subpackage over whole tables, and DuckDB SQL for those that SQL can express.

QUERIES: name -> function of (spark, sf_dir); ORACLES: name -> SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, license_scan, pseudo_likelihood, surrogates
from .common import table
from .decontamination import decontaminate
from .exact_dedup import dedup_exact
from .filter_audit import audit_filters
from .hard_negatives import mine
from .html_text import extract
from .jaccard_join import jaccard_join
from .mixing import mix
from .neighbours import nearest
from .substring_dedup import dedup_substrings


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymise(table(spark, sf_dir, "documents"), surrogates.secret_key(spark))


def op3_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pseudo_likelihood.score(docs, pseudo_likelihood.fit(docs))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(table(spark, sf_dir, "documents"), digest=True)
    return found.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(language.labelled(docs)))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_scan(table(spark, sf_dir, "documents"))

    def joined(*lists):
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*lists))), ",")

    met = F.coalesce(F.array_max("blocks.containment"), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.first").alias("first_word"),
        F.array_max("base.first").alias("last_word"),
        joined("base.label").alias("base_labels"),
        joined("base.label", "blocks.label").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(met).alias("score"),
    )


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_surrogates": op2_surrogates,
    "op3_pseudo_likelihood": op3_pseudo_likelihood,
    "op4_html_text": op4_html_text,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_language": op6_language,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_license_scan": op8_license_scan,
    "op9_neighbours": op9_neighbours,
    "op10_mixing": op10_mixing,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_hard_negatives": op13_hard_negatives,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACE = r"[^\x20\x09-\x0D]+"

_TEMPLATES = ", ".join(f"({k}, '{label}', {sorted(set(t.split()))}, {license_scan.block_of(t)})" for k, (t, label) in enumerate(license_scan.TEMPLATES))
_PHRASES = ", ".join(f"({p.split()}, '{label}')" for p, label in license_scan.PHRASES)

ORACLES = {
    "op1_decontamination": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, list_slice(w, i, i + 9) AS win FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(win) AS n FROM bw),
dw AS (SELECT r, n, i, list_slice(w, i, i + n - 1) AS win FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens)),
hit AS (SELECT r, i, n, item FROM dw JOIN bw USING (win)),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)
""",
    "op5_substring_dedup": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS w FROM documents),
x AS (SELECT r, doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS win FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE doc_id IS NOT NULL)),
f AS (SELECT win, min(doc_id) AS least FROM x GROUP BY win),
gone AS (SELECT r, list_distinct(flatten(list(range(i, i + 13)))) AS places FROM x JOIN f USING (win) WHERE least < doc_id GROUP BY r),
kept AS (SELECT d.r, doc_id, w, coalesce(places, []) AS places, list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(coalesce(places, []), i)) AS stay FROM d LEFT JOIN gone USING (r))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(list_transform(stay, lambda i: w[i]), ' '), '')) AS kept_sha256 FROM kept
""",
    "op7_jaccard_join": rf"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_SPACE}') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d WHERE doc_id IS NOT NULL UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) USING (doc_id)
""",
    "op8_license_scan": rf"""
WITH t AS (SELECT * FROM (VALUES {_TEMPLATES}) AS t(k, label, tokens, blk)),
p AS (SELECT * FROM (VALUES {_PHRASES}) AS p(phrase, label)),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM documents),
base AS (SELECT r, label, i - 1 AS first FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d), p WHERE list_slice(w, i, i + len(phrase) - 1) = phrase),
blocks AS (SELECT r, blk, list_distinct(list_slice(w, i + 1, i + blk)) AS b FROM (SELECT r, w, blk, unnest(range(0, greatest(1, len(w) - blk // 2), blk // 2)) AS i FROM d, (SELECT DISTINCT blk FROM t))),
met AS (SELECT r, label, len(list_intersect(b, tokens)) / len(tokens) AS c FROM blocks JOIN t USING (blk) WHERE list_has_any(b, tokens) AND len(list_intersect(b, tokens)) >= ceil(round({license_scan.THRESHOLD} * len(tokens), 9))),
bases AS (SELECT r, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY r),
every AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM base UNION SELECT r, label FROM met) GROUP BY r),
best AS (SELECT r, max(c) AS c FROM met GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(c, 0) END AS DOUBLE) AS score
FROM d LEFT JOIN bases USING (r) LEFT JOIN every USING (r) LEFT JOIN best USING (r)
""",
    "op10_mixing": rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_SPACE}')) AS BIGINT) AS size,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, 'null')), 1, 6) AS INTEGER) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS BIGINT) AS w,
  2 * source_size AS cap, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS goal FROM s),
c AS (SELECT *, (goal - CAST(coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
  / CAST(sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) >= cap / CAST(w AS DOUBLE) AS capped FROM w WINDOW o AS (ORDER BY cap / CAST(w AS DOUBLE), source ASC NULLS LAST)),
l AS (SELECT *, (goal - CAST(sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS DOUBLE)) / nullif(CAST(sum(CASE WHEN capped THEN 0 ELSE w END) OVER () AS DOUBLE), 0) AS level FROM c),
t AS (SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE least(w * level, CAST(cap AS DOUBLE)) END AS target FROM l),
m AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM t),
x AS (SELECT d.doc_id, d.size, m.*, target - copies * source_size AS rest,
  CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k RANGE UNBOUNDED PRECEDING) AS DOUBLE) AS through, CAST(sum(size) OVER (PARTITION BY d.source, k) AS DOUBLE) AS own
  FROM d JOIN m ON d.source IS NOT DISTINCT FROM m.source)
SELECT doc_id, size, source_size, target, CAST(size * (copies + CASE WHEN copies < 2 AND 2 * through - own <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM x
""",
    "op11_exact_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
w AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY n DESC, doc_id ASC NULLS LAST, r) AS place, count(*) OVER (PARTITION BY t) AS size FROM d)
SELECT w.doc_id, k.doc_id AS keep_id, CAST(w.size AS BIGINT) AS group_size, w.place = 1 AS kept, sha256(w.t) AS text_sha256 FROM w JOIN w k ON w.t = k.t AND k.place = 1
""",
    "op12_filter_audit": rf"""
WITH RECURSIVE f AS (SELECT * FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS f(letter)),
o AS (SELECT letter AS filter_order FROM f UNION ALL SELECT filter_order || letter FROM o, f WHERE NOT contains(filter_order, letter)),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS w FROM documents),
least AS (SELECT text, min(doc_id) AS first FROM t GROUP BY text),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
  || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN first < doc_id THEN 'E' ELSE '' END AS fails
  FROM t JOIN least USING (text) LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, fails),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM o WHERE length(filter_order) = 5)),
x AS (SELECT part, filter_order, step, letter, sum(n) AS n, CAST(coalesce(sum(n) FILTER (here), 0) AS BIGINT) AS removed, CAST(coalesce(sum(n) FILTER (here OR gone), 0) AS BIGINT) AS out, CAST(coalesce(sum(n) FILTER (own AND gone), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (fails = letter), 0) AS BIGINT) AS unique_fails, CAST(coalesce(sum(good) FILTER (here), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(toxic) FILTER (here), 0) AS BIGINT) AS toxic_lost
  FROM (SELECT c.*, s.*, contains(fails, letter) AS own, translate(fails, before, '') <> fails AS gone, own AND NOT gone AS here FROM c, s) GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(n - out AS BIGINT) AS kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM x
""",
    "op13_hard_negatives": """
WITH u AS MATERIALIZED (SELECT row_number() OVER () AS r, CAST(vec_id AS BIGINT) AS vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM u WHERE vec_id % 100 = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, u.vec_id, a.label = u.label AS same, CAST(list_sum(list_transform(range(1, len(u.v) + 1), lambda i: a.v[i] * u.v[i])) AS BIGINT) AS score FROM a JOIN u ON a.vec_id <> u.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
""",
}
