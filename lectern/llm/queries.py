"""The registered queries of this subpackage, and the SQL that some of them are compared with."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm import (
    backoff,
    bond,
    bpe_codec,
    exact_dedup,
    licenses,
    mixing,
    packing,
    simhash,
    spelling,
    token_counts,
    token_files,
    topk,
    toxicity,
)
from lectern.llm.common import LOWER, UPPER


VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"

QUERIES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_exact_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k_search(vectors.where("vec_id % 50 = 0"), vectors)


@query
def op2_source_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op3_simhash_groups(spark, sf_dir):
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.withColumn("fingerprint", simhash.hex_digits(groups.fingerprint))


@query
def op4_length_buckets(spark, sf_dir):
    return packing.pack_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@query
def op5_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    folder = token_files.token_folder(spark)
    manifest = token_files.write_token_files(docs, folder, public_tokenizers.path(VOCABULARY))
    return token_files.read_documents(manifest, folder)


@query
def op6_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@query
def op8_backoff_scores(spark, sf_dir):
    scores = backoff.backoff_scores(table(spark, sf_dir, "documents"))
    return scores.select(
        "doc_id",
        "n_words",
        F.round("log_score", 5).alias("log_score"),
        F.round("mean_log_score", 7).alias("mean_log_score"),
    )


@query
def op9_exact_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.text_digests(docs, exact_dedup.exact_duplicates(docs))


@query
def op10_license_scan(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op11_hard_negatives(spark, sf_dir):
    """Rows with a number divisible by 7 have the next label, and those divisible by 50 are the anchors."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return bond.hard_negatives(vectors, F.col("vec_id") % 50 == 0, label=moved)


@query
def op12_bpe_round_trip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return bpe_codec.round_trip_digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@query
def op13_spelling_variants(spark, sf_dir):
    words = spelling.count_words(spelling.slipped_words(table(spark, sf_dir, "documents")))
    return spelling.group_variants(words)


# ---- SQL -----------------------------------------------------------------------------------------

_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"


def _license_sql() -> str:
    """All blocks against all templates, without any filter."""
    templates = []
    for i, (label, text) in enumerate(licenses.TEMPLATES):
        words = sorted(set(licenses._plain_words(text)))
        templates.append(f"({i}, '{label}', {words!r})")
    phrases = ", ".join(f"('{p}', '{label}', {p.split()!r})" for p, label in licenses.PHRASES.items())
    size, step = licenses.BLOCK_WORDS, licenses.BLOCK_WORDS // 2
    return f"""
WITH phrases(phrase, label, parts) AS (VALUES {phrases}),
templates(template, label, words) AS (VALUES {", ".join(templates)}),
docs AS (
  SELECT doc_id, list_filter(
    string_split_regex({_LOWERED}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
starts AS (
  SELECT doc_id, label, unnest(list_filter(range(len(words)),
    lambda i: words[i + 1:i + len(parts)] = parts)) AS place
  FROM docs, phrases),
base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
    list(DISTINCT label) AS labels
  FROM starts GROUP BY doc_id),
blocks AS (
  SELECT doc_id, list_distinct(words[b * {step} + 1:b * {step} + {size}]) AS held
  FROM (SELECT doc_id, words,
          unnest(range(greatest(0, ceil((len(words) - {size}) / {step}.0))::BIGINT + 1)) AS b FROM docs)),
matches AS (
  SELECT doc_id, label, len(list_intersect(held, t.words)) / len(t.words) AS containment
  FROM blocks, templates t
  WHERE len(list_intersect(held, t.words)) >= greatest(1, ceil(round({licenses.THRESHOLD} * len(t.words), 6)))),
found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(containment) AS best FROM matches GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(
    list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)"""


ORACLES = {
    "op1_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op13_spelling_variants": f"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {0xEDB88320}) ELSE c >> 1 END, i) AS c
    FROM range(256) r(i))),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(
    flatten(list_transform(string_split(doc_id || ':' || run, ''),
      lambda s: CASE WHEN unicode(s) < 128 THEN [unicode(s)::BIGINT] ELSE [195::BIGINT, unicode(s)::BIGINT - 64] END)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), {0xFFFFFFFF}::BIGINT), {0xFFFFFFFF}::BIGINT) AS h FROM runs, crc),
slipped AS (
  SELECT n, CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word
  FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT word, n, left(word, i - 1) || substring(word, i + 1) AS shorter, left(word, i - 1) || '*' || substring(word, i + 1) AS mask
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.mask = b.mask AND a.word <> b.word
  UNION SELECT a.word, w.word, w.n FROM cut a JOIN words w ON a.shorter = w.word
  UNION SELECT w.word, a.word, a.n FROM cut a JOIN words w ON a.shorter = w.word),
best AS (
  SELECT word, near, n, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, near) = 1),
formed AS (
  SELECT w.word, CASE WHEN b.n >= 2 * w.n THEN near END AS form, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN b.n >= 2 * w.n THEN b.n END AS form_n FROM words w LEFT JOIN best b USING (word)),
walk AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT w.word, f.form FROM walk w JOIN formed f ON w.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk w USING (word) JOIN formed g ON g.word = w.at AND g.form IS NULL""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
  (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY rank <= 3""",
    "op8_backoff_scores": f"""
WITH words AS (
  SELECT doc_id, unnest(list_filter(string_split_regex({_LOWERED}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))
    AS word, generate_subscripts(list_filter(string_split_regex({_LOWERED}, '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> ''), 1) AS place FROM documents),
grams AS (
  SELECT doc_id, place, word, lag(word) OVER w AS before, lag(word, 2) OVER w AS first
  FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
counted AS (
  SELECT *, count(*) OVER () - count(*) OVER (PARTITION BY doc_id) AS others,
    count(*) OVER (PARTITION BY word) - count(*) OVER (PARTITION BY doc_id, word) AS n1,
    CASE WHEN before IS NOT NULL THEN count(*) OVER (PARTITION BY before, word)
      - count(*) OVER (PARTITION BY doc_id, before, word) END AS n2,
    CASE WHEN first IS NOT NULL THEN count(*) OVER (PARTITION BY first, before, word)
      - count(*) OVER (PARTITION BY doc_id, first, before, word) END AS n3 FROM grams),
contexts AS (
  SELECT c.*, lag(n1) OVER w AS context, lag(n2) OVER w AS longer FROM counted c
  WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
scored AS (
  SELECT doc_id, CASE WHEN n3 > 0 THEN log10(n3) - log10(longer)
    WHEN n2 > 0 THEN log10(n2) - log10(context) + CASE WHEN first IS NOT NULL THEN log10({backoff.ALPHA}) ELSE 0 END
    ELSE log10(CASE WHEN n1 > 0 THEN n1 ELSE 0.5 END) - log10(greatest(others, 1))
      + CASE WHEN first IS NOT NULL THEN 2 * log10({backoff.ALPHA})
             WHEN before IS NOT NULL THEN log10({backoff.ALPHA}) ELSE 0 END END AS score FROM contexts)
SELECT d.doc_id, count(score) AS n_words, round(coalesce(sum(score), 0.0), 5) AS log_score,
  round(avg(score), 7) AS mean_log_score
FROM documents d LEFT JOIN scored USING (doc_id) GROUP BY d.doc_id""",
    "op9_exact_dedup": f"""
WITH hashed AS (SELECT doc_id, sha256({_LOWERED}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM hashed WINDOW g AS (PARTITION BY text_sha256)""",
    "op10_license_scan": _license_sql(),
}
