"""The same results in SQL, one statement per query, for the tables as given."""

from __future__ import annotations

from checks.queries import CHUNK_SECONDS, EMBED_SECONDS, INDEX_SECONDS, INGEST_SECONDS
from lectern.operators import ivf, prompt

# Character classes of the SQL engine's regular expressions.
WS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
UNPRINTABLE = (
    r"[\x00-\x08\x0b-\x1f\x7f-\x9f\p{Cf}\p{Co}\p{Zl}\p{Zp}"
    r"\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
)


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def dirty(text: str = "text") -> str:
    return (
        f"(chr(160) || '  ' || replace(replace({text}, ' ', ' ' || chr(9) || ' '), '.', "
        "'.' || chr(8203) || chr(13) || chr(10) || chr(10) || ' ') || ' ' || chr(10))"
    )


def normalized(text: str) -> str:
    out = f"regexp_replace({text}, '{UNPRINTABLE}', '', 'g')"
    out = f"regexp_replace({out}, '[ \\t]+', ' ', 'g')"
    out = f"regexp_replace({out}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"regexp_replace({out}, '^[ \\n]+|[ \\n]+$', '', 'g')"


CLEAN = normalized(dirty())


def stable_id(*parts: str) -> str:
    joined = " || chr(31) || ".join(f"CAST({part} AS VARCHAR)" for part in parts)
    return (
        f"regexp_replace(left(sha256({joined}), 32), "
        r"'^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5')"
    )


def words(text: str) -> str:
    return f"len(regexp_extract_all({text}, '[^{WS}]+'))"


def tokens_of(text: str) -> str:
    return f"CAST(trunc({words(text)} * 1.3::DOUBLE) AS BIGINT)"


def terms(text: str) -> str:
    return rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]+')"


def blank(text: str) -> str:
    return f"regexp_full_match({text}, '[{WS}]*')"


def fixed(size: int, overlap: int, source: str = "documents", carry: str = "") -> str:
    """CTE body: fixed windows of the texts of ``source``."""
    step = size - overlap if overlap < size else size
    return f"""
  SELECT doc_id{carry}, row_number() OVER (PARTITION BY doc_id ORDER BY w) - 1 AS chunk_index,
         w * {step} AS char_start, least(w * {step} + {size}, n) AS char_end, chunk_text,
         {tokens_of("chunk_text")} AS token_count
  FROM (SELECT *, substring(text, w * {step} + 1, {size}) AS chunk_text
        FROM (SELECT *, unnest(generate_series(0, CASE WHEN n <= {size} THEN 0
                          ELSE CAST(ceil((n - {size}) / {step}::DOUBLE) AS BIGINT) END)) AS w
              FROM (SELECT *, length(text) AS n FROM {source}) WHERE n > 0))
  WHERE NOT {blank("chunk_text")}"""


def sentence(source: str = "documents", carry: str = "") -> str:
    """CTE bodies: sentence windows of the texts of ``source``, as ``sentence_chunks``."""
    cut = (
        "CASE WHEN s + 1000 < n AND regexp_matches(substring(text, s + 802, 200), '[.!?]') "
        "THEN s + 801 + length(regexp_extract(substring(text, s + 802, 200), '(?s)^(.*[.!?])', 1)) "
        "ELSE s + 1000 END"
    )
    stripped = rf"regexp_replace(substring(text, s + 1, e - s), '^[{WS}]+|[{WS}]+$', '', 'g')"
    return f"""
steps AS (
  SELECT doc_id{carry}, text, length(text) AS n, 0::BIGINT AS s,
         {cut.replace("s + 1000 < n", "0 + 1000 < length(text)").replace("s + ", "0 + ")} AS e
  FROM {source} WHERE NOT {blank("text")}
  UNION ALL
  SELECT doc_id{carry}, text, n, s, {cut} AS e
  FROM (SELECT doc_id{carry}, text, n, e - 100 AS s FROM steps WHERE n > 1000 AND e - 100 < n)
),
cut_windows AS (
  SELECT doc_id{carry}, s, least(e, n) AS e,
         CASE WHEN n <= 1000 THEN text ELSE {stripped} END AS chunk_text
  FROM steps
),
sentence_chunks AS (
  SELECT doc_id{carry}, chunk_text, row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS chunk_index,
         s AS char_start, e AS char_end, count(*) OVER (PARTITION BY doc_id) AS total_chunks
  FROM cut_windows WHERE NOT {blank("chunk_text")}
)"""


HASHED = f"hashed AS (SELECT doc_id, source, {CLEAN} AS text, sha256({CLEAN}) AS hash FROM documents)"

FILES = """files AS (
  SELECT source || '/' || doc_id || '.' || k AS source_path, k AS file_type,
         CAST(strlen(text) AS BIGINT) AS file_size_bytes, text
  FROM (SELECT *, CASE lang WHEN 'en' THEN 'txt' WHEN 'fr' THEN 'md' WHEN 'de' THEN 'log' ELSE 'csv' END AS k
        FROM documents)
)"""

FIXED_CHUNKS = f"""chunks AS (
  SELECT {stable_id("doc_id", "'fixed'", "chunk_index", "sha256(chunk_text)")} AS chunk_id, * FROM ({fixed(512, 50)})
)"""


def tfidf(units: str, keys: str, text: str) -> str:
    """CTE bodies: terms, idf, weights and norms of ``units``, and the same of the questions."""
    on = " AND ".join(f"a.{key.strip()} = b.{key.strip()}" for key in keys.split(","))
    return f"""
unit_tokens AS (SELECT {keys}, {terms(text)} AS ts FROM {units}),
unit_terms AS (
  SELECT {keys}, token, count(*) AS c, any_value(total) AS total
  FROM (SELECT {keys}, unnest(ts) AS token, len(ts) AS total FROM unit_tokens) GROUP BY {keys}, token
),
idf AS (
  SELECT token, count(*) AS df, ln((SELECT count(*) FROM {units}) / (count(*) + 1)::DOUBLE) AS idf
  FROM unit_terms GROUP BY token
),
weights AS (SELECT {keys}, token, c / total::DOUBLE * idf AS w FROM unit_terms JOIN idf USING (token)),
norms AS (SELECT {keys}, sqrt(sum(w * w)) AS norm FROM weights GROUP BY {keys}),
query_terms AS (
  SELECT query_id, token, count(*) AS c, any_value(total) AS total
  FROM (SELECT item_id AS query_id, unnest({terms("text")}) AS token, len({terms("text")}) AS total
        FROM benchmark) GROUP BY query_id, token
),
query_weights AS (SELECT query_id, token, c / total::DOUBLE * idf AS w FROM query_terms JOIN idf USING (token)),
query_norms AS (SELECT query_id, sqrt(sum(w * w)) AS norm FROM query_weights GROUP BY query_id),
dots AS (
  SELECT query_id, {keys}, sum(d.w * q.w) AS dot
  FROM weights d JOIN query_weights q USING (token) GROUP BY query_id, {keys}
),
scored AS (
  SELECT a.*, dot / nullif(b.norm * q.norm, 0) AS similarity
  FROM dots a JOIN norms b ON {on} JOIN query_norms q ON a.query_id = q.query_id
)"""


def tfidf_topk(keys: str) -> str:
    latest = ", ".join(f"{key.strip()} DESC" for key in keys.split(","))
    return f"""
SELECT query_id, {keys}, round(similarity, 6) AS similarity,
       row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 9) DESC, {latest}) AS rank
FROM scored WHERE similarity > 0 QUALIFY rank <= 5"""


def hashed_vectors(source: str, key: str, text: str, name: str) -> str:
    """CTE bodies: bucket counts of hashed tokens as (key, bucket, v) rows, and the squared length."""
    return f"""
{name}_buckets AS (
  SELECT {key}, bucket, count(*) AS v
  FROM (SELECT {key}, ('0x' || left(md5(token), 8))::BIGINT % 64 AS bucket
        FROM (SELECT {key}, unnest({terms(text)}) AS token FROM {source})) GROUP BY {key}, bucket
),
{name}_lengths AS (
  SELECT s.{key}, coalesce(sum(v * v), 0) AS len2
  FROM {source} s LEFT JOIN {name}_buckets b ON s.{key} = b.{key} GROUP BY s.{key}
)"""


PAIRS = """parts AS (SELECT vec_id, label, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
means AS (SELECT label, i, avg(x) AS m FROM parts GROUP BY label, i),
asked AS (SELECT label::BIGINT AS query_id, list(m ORDER BY i)::DOUBLE[64] AS v FROM means GROUP BY label),
pairs AS (
  SELECT query_id, vec_id, label, array_distance(v, embedding::DOUBLE[64]) AS d FROM asked, embeddings
)"""


def ranked(source: str, k: int, name: str = "rank") -> str:
    return (
        f"SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS {name} "
        f"FROM {source} QUALIFY {name} <= {k}"
    )


IVF = """
n AS (SELECT count(*) AS n FROM embeddings),
params AS (SELECT n, greatest(1, least(CAST(floor(2 * sqrt(n)) AS BIGINT), n // 39)) AS nlist FROM n),
centroids AS (
  SELECT row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR))) - 1 AS list_id, embedding AS centroid
  FROM embeddings QUALIFY list_id < (SELECT nlist FROM params)
),
to_lists AS (
  SELECT vec_id, list_id, row_number() OVER (PARTITION BY vec_id
           ORDER BY array_distance(embedding::DOUBLE[64], centroid::DOUBLE[64]), list_id) AS near
  FROM embeddings, centroids
),
assigned AS (SELECT vec_id, list_id FROM to_lists WHERE near = 1),
probed AS (
  SELECT query_id, list_id, row_number() OVER (PARTITION BY query_id
           ORDER BY array_distance(v, centroid::DOUBLE[64]), list_id) AS near
  FROM asked, centroids QUALIFY near <= 3
),
reached AS (
  SELECT p.query_id, a.vec_id, pairs.d
  FROM probed p JOIN assigned a USING (list_id) JOIN pairs ON pairs.query_id = p.query_id AND pairs.vec_id = a.vec_id
)"""

def distances(documents: str) -> str:
    """CTE bodies: the fixed chunks of a table, and their distance to every question in the hashed embedding."""
    return f"""
questions AS (SELECT item_id AS query_id, text AS query_text FROM benchmark),
chunks AS (
  SELECT {stable_id("doc_id", "'fixed'", "chunk_index", "sha256(chunk_text)")} AS chunk_id, *
  FROM ({fixed(512, 50, documents, ", source")})
),{hashed_vectors("chunks", "chunk_id", "chunk_text", "c")},{hashed_vectors("questions", "query_id", "query_text", "q")},
products AS (
  SELECT query_id, chunk_id, sum(q.v * c.v) AS dot FROM q_buckets q JOIN c_buckets c USING (bucket)
  GROUP BY query_id, chunk_id
),
distances AS (
  SELECT q.query_id, c.chunk_id, q.len2 + c.len2 - 2 * coalesce(dot, 0) AS d
  FROM q_lengths q CROSS JOIN c_lengths c LEFT JOIN products p ON p.query_id = q.query_id AND p.chunk_id = c.chunk_id
)"""


RETRIEVED = f"""{distances("documents")},
nearest AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, chunk_id) AS rank
  FROM distances QUALIFY rank <= 5
),
retrieved AS (
  SELECT query_id, rank, chunk_id, doc_id, source AS source_path, chunk_text, CAST(d AS DOUBLE) AS similarity_score
  FROM nearest JOIN chunks USING (chunk_id)
)"""

DELIVERED = """delivered AS (
  SELECT doc_id, source, CASE WHEN quality IS NULL THEN text || ' edited' ELSE text END AS text
  FROM documents LEFT JOIN labels USING (doc_id) WHERE toxic IS DISTINCT FROM 1)"""

# Requests by the number of the question: how many results, and which chunks match.
TOP_K = "CASE WHEN query_id % 22 = 5 THEN 5 ELSE query_id % 22 END"
REQUESTED = f"""
WITH {distances("documents")},
matching AS (
  SELECT d.*, source, chunk_index FROM distances d JOIN chunks USING (chunk_id)
  WHERE {TOP_K} BETWEEN 1 AND 20 AND CASE query_id % 6
    WHEN 0 THEN true WHEN 1 THEN source IN ('src3', 'src8') WHEN 2 THEN chunk_index IN (0, 2)
    WHEN 3 THEN source = 'src5' AND chunk_index = 0 ELSE false END)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY d, chunk_id) AS rank, chunk_id, source AS source_path,
  chunk_index::BIGINT AS chunk_index, CAST(d AS DOUBLE) AS similarity_score
FROM matching QUALIFY rank <= {TOP_K}"""

INGESTED = f"""{FILES},
ingested AS (SELECT file_type <> 'csv' AS ok, CASE WHEN file_type <> 'csv' THEN sha256(text) END AS hash FROM files),
ingestion AS (
  SELECT count(DISTINCT hash) AS documents_processed,
         CAST(count_if(NOT ok) AS BIGINT) AS parse_failures,
         CAST(count_if(ok) - count(DISTINCT hash) AS BIGINT) AS duplicates_removed,
         {INGEST_SECONDS}::DOUBLE AS processing_time_seconds,
         round(count(DISTINCT hash) / {INGEST_SECONDS}::DOUBLE * 60, 2) AS documents_per_minute
  FROM ingested
)"""
CHUNKED = f"""{FIXED_CHUNKS},
chunking AS (
  SELECT count(*) AS total_chunks, (SELECT count(*) FROM documents) AS total_documents,
         round(avg(token_count), 2) AS average_chunk_size, {CHUNK_SECONDS}::DOUBLE AS processing_time_seconds,
         round(count(*) / {CHUNK_SECONDS}::DOUBLE, 2) AS chunks_per_second
  FROM chunks
)"""
EMBEDDED = f"""embedding AS (
  SELECT count(*) AS total_embeddings, 'hashed-bag-of-words' AS model_name, 'cpu' AS device,
         {EMBED_SECONDS}::DOUBLE AS processing_time_seconds,
         round(count(*) / {EMBED_SECONDS}::DOUBLE, 2) AS chunks_per_second
  FROM chunks
)"""
INDEXED = f"""vector_store AS (
  SELECT count(*) AS total_vectors, 'Flat' AS index_type, {INDEX_SECONDS}::DOUBLE AS build_time_seconds
  FROM embeddings
)"""
STAGES = f"WITH {INGESTED}, {CHUNKED}, {EMBEDDED}, {INDEXED}"

CHUNK_FIELDS = "doc_id, chunk_index, char_start, char_end, chunk_text, token_count"


def _change_sql() -> str:
    return """
WITH labelled AS (SELECT d.doc_id, d.text, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)),
stored AS (SELECT doc_id, sha256(CASE WHEN quality = 0 THEN text || ' old' ELSE text END) AS stored_hash FROM labelled),
incoming AS (
  SELECT doc_id, sha256(text) AS incoming_hash FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labelled WHERE toxic = 1)
)
SELECT doc_id, stored_hash, incoming_hash,
       CASE WHEN stored_hash IS NULL THEN 'new' WHEN incoming_hash IS NULL THEN 'deleted'
            WHEN stored_hash <> incoming_hash THEN 'changed' ELSE 'same' END AS status
FROM stored FULL JOIN incoming USING (doc_id)"""


def _prompt_sql() -> str:
    before, rest = prompt.PROMPT.split("{context}")
    between, after = rest.split("{query}")
    block = (
        "'[Document ' || rank || '] (Source: ' || coalesce(source_path, 'Unknown') || ')' "
        "|| chr(10) || coalesce(chunk_text, '')"
    )
    return f"""WITH {RETRIEVED}
SELECT query_id, {literal(before)} || string_agg({block}, chr(10) || chr(10) ORDER BY rank) || {literal(between)}
         || any_value(query_text) || {literal(after)} AS prompt
FROM retrieved JOIN questions USING (query_id) GROUP BY query_id"""


def _answer_sql(header: str, length: int, condition: str) -> str:
    line = f"'[' || rank || '] ' || left(chunk_text, {length}) || '...'"
    return f"""WITH {RETRIEVED}
SELECT query_id, {literal(header)} || string_agg({line}, chr(10) || chr(10) ORDER BY rank) AS answer
FROM retrieved WHERE {condition} GROUP BY query_id"""


def trained_ivf(rounds: int, probes: int) -> str:
    """CTE bodies: k-means from the same seed centroids, round by round, then as IVF."""
    seeds = IVF[: IVF.index("to_lists AS")].replace("centroids AS", "c0 AS").replace(
        "embedding AS centroid", "embedding::DOUBLE[64] AS centroid"
    )
    steps = ""
    for r in range(rounds + 1):
        steps += f"""
near{r} AS (
  SELECT vec_id, list_id FROM embeddings, c{r}
  QUALIFY row_number() OVER (PARTITION BY vec_id
    ORDER BY array_distance(embedding::DOUBLE[64], centroid), list_id) = 1
),"""
        if r < rounds:
            steps += f"""
means{r} AS (SELECT list_id, i, avg(x) AS m FROM near{r} JOIN parts USING (vec_id) GROUP BY list_id, i),
lists{r} AS (SELECT list_id, list(m ORDER BY i)::DOUBLE[64] AS mean FROM means{r} GROUP BY list_id),
c{r + 1} AS (SELECT list_id, coalesce(mean, centroid) AS centroid FROM c{r} LEFT JOIN lists{r} USING (list_id)),"""
    return f"""{seeds}{steps}
probed AS (
  SELECT query_id, list_id FROM asked, c{rounds}
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY array_distance(v, centroid), list_id) <= {probes}
),
reached AS (
  SELECT p.query_id, a.vec_id, pairs.d FROM probed p JOIN near{rounds} a USING (list_id)
  JOIN pairs ON pairs.query_id = p.query_id AND pairs.vec_id = a.vec_id
)"""


ORACLES = {
    "normalize_text": f"SELECT doc_id, {CLEAN} AS text FROM documents",
    "content_hash": f"SELECT doc_id, sha256({CLEAN}) AS hash FROM documents",
    "assign_ids": f"""
WITH named AS (SELECT doc_id, {stable_id("source || '/' || doc_id", "sha256(text)")} AS document_id, sha256(text) AS hash
  FROM documents)
SELECT doc_id, document_id, {stable_id("document_id", "'fixed'", "0", "hash")} AS first_chunk_id FROM named""",
    "token_count": f"SELECT doc_id, {words('text')} AS words, {tokens_of('text')} AS tokens FROM documents",
    "tokenize": f"SELECT doc_id, array_to_string({terms('text')}, ' ') AS tokens FROM documents",
    "file_type": r"""
SELECT page_id, url, lower(regexp_extract(url, '[^/.][^/]*\.([^/.]*)$', 1)) AS file_type FROM pages""",
    "preview": """
SELECT doc_id, CASE WHEN length(text) > 300 THEN left(text, 300) || '...' ELSE text END AS page_preview,
       CASE WHEN length(text) > 80 THEN left(text, 80) || '...' ELSE text END AS console_preview,
       left(text, 200) || '...' AS answer_preview
FROM documents""",
    "decode_text": r"""
SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN text
                    ELSE regexp_replace(text, '[^\x{00}-\x{ff}]', '?', 'g') END AS text
FROM documents""",
    "parse_dispatch": f"""
WITH {FILES}
SELECT source_path, file_type, file_size_bytes, CASE WHEN file_type <> 'csv' THEN text END AS text,
       CASE WHEN file_type <> 'csv' THEN 1::BIGINT END AS page_count, file_type <> 'csv' AS parse_success,
       CASE WHEN file_type = 'csv' THEN 'Unsupported file type: csv' END AS error_message
FROM files""",
    "quarantine": f"""
WITH {FILES}
SELECT source_path, file_type, 'Unsupported file type: csv' AS error, 'run-1' AS run FROM files WHERE file_type = 'csv'""",
    "parse_placeholder": f"""
WITH {FILES}
SELECT source_path, CASE WHEN file_type <> 'csv' THEN text ELSE '[PDF file: ' || split_part(source_path, '/', 2)
         || ' - Error reading: Unsupported file type: csv]' END AS text
FROM files""",
    "page_assemble": """
SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS page_count,
       array_to_string(list_filter(string_split(text, chr(10)), lambda page: contains(page, '.')), chr(10)) AS text
FROM documents""",
    "chunk_fixed": f"SELECT {CHUNK_FIELDS} FROM ({fixed(512, 50)})",
    "chunk_fixed_100_10": f"SELECT {CHUNK_FIELDS} FROM ({fixed(100, 10)})",
    "chunk_overlap_clamp": f"SELECT {CHUNK_FIELDS} FROM ({fixed(300, 400)})",
    "chunk_sentence": f"WITH RECURSIVE {sentence()} SELECT * FROM sentence_chunks",
    "chunk_strategies": f"""
WITH RECURSIVE {sentence()}
SELECT {stable_id("doc_id", "'fixed'", "chunk_index", "sha256(chunk_text)")} AS chunk_id, doc_id, 'fixed' AS chunking_strategy,
       chunk_index, chunk_text FROM ({fixed(512, 50)})
UNION ALL
SELECT {stable_id("doc_id", "'semantic'", "chunk_index", "sha256(chunk_text)")}, doc_id, 'semantic', chunk_index, chunk_text
FROM sentence_chunks""",
    "chunk_enrich": f"""
SELECT c.doc_id, chunk_index, token_count, lang, source, quality::BIGINT AS quality, toxic::BIGINT AS toxic
FROM ({fixed(512, 50)}) c LEFT JOIN documents d USING (doc_id) LEFT JOIN labels l USING (doc_id)""",
    "dedup_exact": f"""
WITH {HASHED} SELECT * FROM hashed QUALIFY row_number() OVER (PARTITION BY hash ORDER BY doc_id) = 1""",
    "dedup_stats": f"""
WITH {HASHED}
SELECT count(*) AS documents_read, count(DISTINCT hash) AS documents_kept,
       count(*) - count(DISTINCT hash) AS duplicates_removed FROM hashed""",
    "ingest_resume": f"""
WITH {HASHED}
SELECT doc_id, hash FROM hashed
WHERE hash NOT IN (SELECT hash FROM hashed JOIN labels USING (doc_id))""",
    "change_detect": _change_sql(),
    "page_rows": "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 100 OFFSET 100",
    "write_batches": """
SELECT doc_id, source, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 300 AS BIGINT) AS batch FROM documents""",
    "latest_checkpoint": """
SELECT 'checkpoint_' || max(doc_id) AS latest, max(doc_id) AS number FROM documents WHERE lang = 'en'""",
    "term_frequency": f"""
WITH {tfidf("documents", "doc_id", "text")}
SELECT doc_id, token, c AS term_count, CAST(total AS BIGINT) AS total_tokens FROM unit_terms""",
    "document_frequency": f"""
SELECT token, count(DISTINCT doc_id) AS df
FROM (SELECT doc_id, unnest({terms("text")}) AS token FROM documents) GROUP BY token""",
    "vocabulary": f"""
SELECT token, row_number() OVER (ORDER BY token) - 1 AS token_index
FROM (SELECT DISTINCT unnest({terms("text")}) AS token FROM documents)""",
    "idf": f"WITH {tfidf('documents', 'doc_id', 'text')} SELECT token, df, round(idf, 9) AS idf FROM idf",
    "idf_merged": f"""
WITH {DELIVERED},{tfidf("delivered", "doc_id", "text")} SELECT token, df, round(idf, 9) AS idf FROM idf""",
    "tfidf_vectors": f"""
WITH {tfidf("documents", "doc_id", "text")} SELECT doc_id, token, round(w, 9) AS weight FROM weights""",
    "tfidf_topk": f"""
WITH RECURSIVE {sentence()},{tfidf("sentence_chunks", "doc_id, chunk_index", "chunk_text")}
{tfidf_topk("doc_id, chunk_index")}""",
    "tfidf_index_topk": f"WITH {tfidf('documents', 'doc_id', 'text')} {tfidf_topk('doc_id')}",
    "embed_input": f"WITH {FIXED_CHUNKS} SELECT chunk_id, chunk_text FROM chunks",
    "embed_hashed": f"""
WITH {FIXED_CHUNKS},{hashed_vectors("chunks", "chunk_id", "chunk_text", "c")},
slots AS (SELECT chunk_id, unnest(range(64)) AS bucket FROM chunks)
SELECT chunk_id, string_agg(CAST(coalesce(v, 0) AS VARCHAR), ',' ORDER BY bucket) AS embedding
FROM slots LEFT JOIN c_buckets USING (chunk_id, bucket) GROUP BY chunk_id""",
    "embed_resume": f"""
WITH {FIXED_CHUNKS}
SELECT chunk_id, doc_id FROM chunks WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "rechunk_resume": f"""
WITH chunks AS (
  SELECT {stable_id("doc_id", "'fixed'", "chunk_index", "sha256(chunk_text)")} AS chunk_id, * FROM ({fixed(300, 30)})
),{hashed_vectors("chunks", "chunk_id", "chunk_text", "c")},
slots AS (SELECT chunk_id, unnest(range(64)) AS bucket FROM chunks)
SELECT chunk_id, string_agg(CAST(coalesce(v, 0) AS VARCHAR), ',' ORDER BY bucket) AS embedding
FROM slots LEFT JOIN c_buckets USING (chunk_id, bucket) GROUP BY chunk_id""",
    "apply_changes": f"""
WITH {DELIVERED},
chunks AS (
  SELECT {stable_id("doc_id", "'fixed'", "chunk_index", "sha256(chunk_text)")} AS chunk_id, *
  FROM ({fixed(512, 50, "delivered", ", source")})
),{hashed_vectors("chunks", "chunk_id", "chunk_text", "c")},
slots AS (SELECT chunk_id, unnest(range(64)) AS bucket FROM chunks),
vectors AS (
  SELECT chunk_id, string_agg(CAST(coalesce(v, 0) AS VARCHAR), ',' ORDER BY bucket) AS embedding
  FROM slots LEFT JOIN c_buckets USING (chunk_id, bucket) GROUP BY chunk_id)
SELECT chunk_id, CAST(d.doc_id AS VARCHAR) AS doc_id, d.source || '/' || d.doc_id AS source_path, embedding
FROM delivered d LEFT JOIN chunks c ON c.doc_id = d.doc_id LEFT JOIN vectors USING (chunk_id)""",
    "embedding_index": f"""
WITH {FIXED_CHUNKS}
SELECT chunk_id, row_number() OVER (ORDER BY chunk_id) - 1 AS embedding_index, 'hashed-bag-of-words' AS model_name,
       64::BIGINT AS embedding_dim, 'run-1' AS run FROM chunks""",
    "knn_flat": f"WITH {PAIRS} SELECT query_id, vec_id, round(d * d, 6) AS distance, rank FROM ({ranked('pairs', 10)})",
    "knn_ivf_exact": f"WITH {PAIRS} SELECT query_id, vec_id, round(d * d, 6) AS distance, rank FROM ({ranked('pairs', 10)})",
    "knn_ivf_filtered": f"""
WITH {PAIRS}, wanted AS (SELECT * FROM pairs WHERE label IN (2, 5))
SELECT query_id, vec_id, round(d * d, 6) AS distance, rank, label::BIGINT AS label
FROM ({ranked("wanted", 5)})""",
    "ivf_extents": f"""
WITH {PAIRS},{IVF}
SELECT list_id, count(*) AS size, round(min(array_distance(embedding::DOUBLE[64], centroid::DOUBLE[64])), 6) AS near,
  round(max(array_distance(embedding::DOUBLE[64], centroid::DOUBLE[64])), 6) AS far
FROM assigned JOIN embeddings USING (vec_id) JOIN centroids USING (list_id) GROUP BY list_id""",
    "retrieve_requests": REQUESTED,
    "retrieve_requests_lists": REQUESTED,
    "requests_rejected": f"""
SELECT query_id, CASE WHEN {TOP_K} NOT BETWEEN 1 AND 20 THEN 'top_k must be between 1 and 20'
  ELSE 'filters must be a JSON object' END AS error
FROM (SELECT item_id AS query_id FROM benchmark) WHERE {TOP_K} NOT BETWEEN 1 AND 20 OR query_id % 6 = 5""",
    "merge_index": f"""
WITH {DELIVERED},{distances("delivered")}
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY d, chunk_id) AS rank, chunk_id,
  source || '/' || doc_id AS source_path, chunk_text, CAST(d AS DOUBLE) AS similarity_score
FROM distances JOIN chunks USING (chunk_id) QUALIFY rank <= 5""",
    "merged_entries": f"""
WITH {DELIVERED},
chunks AS (
  SELECT {stable_id("doc_id", "'fixed'", "chunk_index", "sha256(chunk_text)")} AS chunk_id, *
  FROM ({fixed(512, 50, "delivered", ", source")})
),{hashed_vectors("chunks", "chunk_id", "chunk_text", "c")},
slots AS (SELECT chunk_id, unnest(range(64)) AS bucket FROM chunks),
vectors AS (
  SELECT chunk_id, string_agg(CAST(coalesce(v, 0) AS VARCHAR), ',' ORDER BY bucket) AS embedding
  FROM slots LEFT JOIN c_buckets USING (chunk_id, bucket) GROUP BY chunk_id)
SELECT chunk_id, CAST(doc_id AS VARCHAR) AS doc_id, source || '/' || doc_id AS source_path,
  chunk_index::BIGINT AS chunk_index, token_count::BIGINT AS token_count, embedding
FROM chunks JOIN vectors USING (chunk_id)""",
    "vector_metadata": f"""
WITH {PAIRS}
SELECT query_id, rank, vec_id, quality::BIGINT AS quality, toxic::BIGINT AS toxic
FROM ({ranked("pairs", 3)}) p LEFT JOIN labels l ON l.doc_id = p.vec_id""",
    "knn_filtered": """
SELECT vec_id, label = 3 AS equal, label IN (1, 4, 7) AS member,
       label IN (1, 4, 7) AND coalesce(quality = 1, false) AS both, false AS empty_list,
       false AS unknown_key, quality IS NULL AS none, true AS no_filter, false AS other_type,
       label IN (3, 4) AS mixed_list
FROM embeddings LEFT JOIN labels ON labels.doc_id = embeddings.vec_id""",
    "knn_prefilter": f"""
WITH {PAIRS}, wanted AS (SELECT * FROM pairs WHERE label IN (2, 5))
SELECT query_id, vec_id, round(d * d, 6) AS distance, rank, label::BIGINT AS label
FROM ({ranked("wanted", 5)})""",
    "knn_postfilter": f"""
WITH {PAIRS}, fetched AS ({ranked("pairs", 50, "place")}), wanted AS (SELECT * FROM fetched WHERE label IN (2, 5))
SELECT query_id, vec_id, round(d * d, 6) AS distance, rank, label::BIGINT AS label
FROM ({ranked("wanted", 5)})""",
    "ivf_params": """
WITH n AS (SELECT count(*) AS n FROM embeddings),
params AS (SELECT n, greatest(1, least(CAST(floor(2 * sqrt(n)) AS BIGINT), n // 39)) AS nlist FROM n)
SELECT n AS total_vectors, nlist, least(10, nlist) AS nprobe FROM params""",
    "ivf_assign": f"WITH {PAIRS},{IVF} SELECT vec_id, list_id FROM assigned",
    "knn_ivf": f"""
WITH {PAIRS},{IVF} SELECT query_id, vec_id, round(d * d, 6) AS distance, rank FROM ({ranked("reached", 10)})""",
    "knn_ivf_trained": f"""
WITH {PAIRS},{trained_ivf(ivf.TRAINING_ROUNDS, ivf.PROBES)}
SELECT query_id, vec_id, round(d * d, 6) AS distance, rank FROM ({ranked("reached", 10)})""",
    "recall_at_k": f"""
WITH {PAIRS},{IVF}, approximate AS ({ranked("reached", 10)}), exact AS ({ranked("pairs", 10)})
SELECT e.query_id, count(a.vec_id) / 10.0::DOUBLE AS recall
FROM exact e LEFT JOIN approximate a ON a.query_id = e.query_id AND a.vec_id = e.vec_id GROUP BY e.query_id""",
    "pair_distance": f"""
WITH {PAIRS}
SELECT vec_id, round(sum((x - m) * (x - m)), 6) AS distance FROM parts JOIN means USING (label, i) GROUP BY vec_id""",
    "index_validate": """
WITH v AS (
  SELECT vec_id, embedding FROM embeddings
  UNION ALL SELECT vec_id, embedding FROM embeddings WHERE vec_id % 100 = 0
  UNION ALL SELECT -1 - vec_id, list_transform(embedding, lambda x: 'inf'::FLOAT) FROM embeddings WHERE vec_id % 200 = 0),
c AS (
  SELECT (SELECT count(*) FROM v) AS total_vectors,
         (SELECT count(*) FROM v WHERE len(embedding) <> 64) AS wrong_dimension,
         (SELECT count(*) FROM v WHERE embedding IS NULL
             OR len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0) AS not_finite,
         (SELECT count(*) - count(DISTINCT vec_id) FROM v) AS repeated_vectors,
         (SELECT count(*) FROM labels) AS total_ids,
         (SELECT count(*) - count(DISTINCT doc_id) FROM labels) AS repeated_ids,
         (SELECT count(*) FROM v WHERE vec_id NOT IN (SELECT doc_id FROM labels)) AS without_metadata,
         (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT vec_id FROM v)) AS without_vector)
SELECT *, total_vectors = total_ids AND wrong_dimension = 0 AND not_finite = 0 AND without_vector = 0
  AND repeated_vectors = 0 AND repeated_ids = 0 AS valid
FROM c""",
    "index_stats": """
SELECT count(*) AS total_vectors, 'Flat' AS index_type, CAST(max(len(embedding)) AS BIGINT) AS embedding_dim
FROM embeddings""",
    "batch_retrieve": f"""
WITH {RETRIEVED}
SELECT query_id, rank, chunk_id, doc_id, source_path, chunk_text, similarity_score FROM retrieved""",
    "stored_positions": f"""
WITH {FIXED_CHUNKS}
SELECT chunk_id, row_number() OVER (ORDER BY chunk_id) - 1 AS embedding_index, 'hashed-bag-of-words' AS model_name,
       64::BIGINT AS embedding_dim FROM chunks""",
    "retrieve_index": f"""
WITH {RETRIEVED}
SELECT query_id, rank, chunk_id, doc_id, source_path, chunk_text, similarity_score FROM retrieved""",
    "respond_index": f"""
SELECT query_id, num_chunks_retrieved, prompt, answer
FROM (WITH {RETRIEVED} SELECT query_id, count(*) AS num_chunks_retrieved FROM retrieved GROUP BY query_id)
JOIN ({_prompt_sql()}) USING (query_id)
JOIN ({_answer_sql(prompt.ANSWER_HEADER, prompt.ANSWER_CHARS, "true")}) USING (query_id)""",
    "ingest_files": f"""
SELECT DISTINCT sha256(clean) AS hash, clean AS text, 'txt' AS file_type, 1::BIGINT AS page_count,
  '1.0.0' AS parser_version
FROM (SELECT {normalized("text")} AS clean FROM documents)""",
    "source_list": f"""
WITH {RETRIEVED}
SELECT query_id, string_agg(rank || '|' || chunk_id || '|' || doc_id || '|' || source_path || '|'
         || CAST(similarity_score AS BIGINT), ';' ORDER BY rank) AS sources, count(*) AS num_chunks_retrieved
FROM retrieved GROUP BY query_id""",
    "retrieval_outcome": f"""
WITH {RETRIEVED},
kept AS (SELECT query_id FROM retrieved WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))
SELECT query_id, count(k.query_id) AS num_chunks_retrieved, count(k.query_id) > 0 AS found,
       42.1::DOUBLE AS retrieval_ms, 1200.0::DOUBLE AS generation_ms, 1242.1::DOUBLE AS total_ms
FROM questions LEFT JOIN kept k USING (query_id) GROUP BY query_id""",
    "format_prompt": _prompt_sql(),
    "extractive_answer": _answer_sql(prompt.ANSWER_HEADER, prompt.ANSWER_CHARS, "true"),
    "error_answer": _answer_sql(
        prompt.ERROR_HEADER + "timeout" + prompt.ERROR_MIDDLE,
        prompt.ERROR_CHARS,
        f"rank <= {prompt.ERROR_CHUNKS}",
    ),
    "ingest_metrics": f"WITH {INGESTED} SELECT * FROM ingestion",
    "chunk_metrics": f"WITH {CHUNKED} SELECT * FROM chunking",
    "embed_metrics": f"WITH {FIXED_CHUNKS}, {EMBEDDED} SELECT * FROM embedding",
    "corpus_stats": f"""
WITH RECURSIVE {sentence(carry=", source")}
SELECT count(*) AS chunks, count(DISTINCT source) AS sources FROM sentence_chunks""",
    "run_summary": f"""{STAGES}
SELECT round(i.processing_time_seconds + c.processing_time_seconds + e.processing_time_seconds
             + v.build_time_seconds, 2) AS total_seconds,
       round((i.processing_time_seconds + c.processing_time_seconds + e.processing_time_seconds
             + v.build_time_seconds) / 60.0::DOUBLE, 2) AS total_minutes,
       documents_processed AS documents, total_embeddings AS embeddings,
       round(total_embeddings / documents_processed::DOUBLE, 2) AS embeddings_per_document,
       round(total_chunks / total_documents::DOUBLE, 2) AS chunks_per_document
FROM ingestion i, chunking c, embedding e, vector_store v""",
    "metrics_row": f"""{STAGES}
SELECT documents_processed AS ingestion_docs, parse_failures AS ingestion_failures,
       duplicates_removed AS ingestion_duplicates, i.processing_time_seconds AS ingestion_time_s,
       documents_per_minute AS ingestion_throughput, total_chunks AS chunking_chunks,
       total_documents AS chunking_docs, average_chunk_size AS chunking_avg_size,
       c.processing_time_seconds AS chunking_time_s, c.chunks_per_second AS chunking_throughput,
       total_embeddings AS embedding_count, model_name AS embedding_model, device AS embedding_device,
       e.processing_time_seconds AS embedding_time_s, e.chunks_per_second AS embedding_throughput,
       total_vectors AS vector_store_vectors, index_type AS vector_store_type,
       build_time_seconds AS vector_store_build_time_s
FROM ingestion i, chunking c, embedding e, vector_store v""",
    "target_assessment": f"""{STAGES},
actuals AS (
  SELECT 'ingestion' AS stage, documents_per_minute AS actual, 1000.0::DOUBLE AS target, 'docs/min' AS unit FROM ingestion
  UNION ALL SELECT 'chunking', chunks_per_second, 5000.0, 'chunks/sec' FROM chunking
  UNION ALL SELECT 'embedding', chunks_per_second, 200.0, 'chunks/sec' FROM embedding)
SELECT stage, round(actual, 2) AS actual, target, unit,
       CASE WHEN actual > 0 THEN round(actual / target * 100, 1) END AS percent,
       CASE WHEN actual <= 0 THEN 'no data' WHEN actual / target >= 0.8 THEN 'ok'
            WHEN actual / target >= 0.5 THEN 'warn' ELSE 'fail' END AS status
FROM actuals""",
    "scale_projection": f"""{STAGES}
SELECT scale, chunks, round(chunks / chunks_per_second / per, 1) AS amount, unit
FROM embedding, (VALUES ('10k', 10000::BIGINT, 'minutes', 60.0::DOUBLE), ('100k', 100000, 'minutes', 60.0),
                        ('1M', 1000000, 'hours', 3600.0)) AS scales(scale, chunks, unit, per)""",
    "documents_to_chunks": f"""
WITH cleaned AS (SELECT doc_id, lang, source, {CLEAN} AS text FROM documents),
hashed AS (SELECT *, sha256(text) AS hash FROM cleaned),
kept AS (SELECT * FROM hashed QUALIFY row_number() OVER (PARTITION BY hash ORDER BY doc_id) = 1)
SELECT {stable_id("doc_id", "'fixed'", "chunk_index", "sha256(chunk_text)")} AS chunk_id, doc_id, chunk_text, chunk_index, char_start,
       char_end, token_count, 'fixed' AS chunking_strategy, hash, lang, source
FROM ({fixed(512, 50, "kept", ", hash, lang, source")})""",
}

ORACLES["scan_flat"] = """
SELECT 'txt' AS file_type, line, count(*) AS copies
FROM (SELECT unnest(string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))) AS line
      FROM documents WHERE lang = 'en')
WHERE line <> '' GROUP BY line"""

ORACLES["embed_named"] = f"""
WITH {FIXED_CHUNKS}
SELECT chunk_id, length(chunk_text) || ',' || length(regexp_replace(chunk_text, '[^ ]', '', 'g')) || ','
    || length(regexp_replace(chunk_text, '[^e]', '', 'g')) AS embedding, 'letters' AS model_name, 3::BIGINT AS embedding_dim
FROM chunks"""

ORACLES["stage_metrics"] = f"""
WITH clean AS (SELECT doc_id, {normalized("text")} AS text FROM documents),
kept AS (SELECT min(doc_id) AS doc_id, text FROM clean GROUP BY text),
cut AS ({fixed(512, 50, "kept")})
SELECT 'ingestion' AS stage, (SELECT count(*) FROM kept) AS documents_processed, 0::BIGINT AS parse_failures,
  (SELECT count(*) FROM clean) - (SELECT count(*) FROM kept) AS duplicates_removed, NULL::BIGINT AS total_chunks,
  NULL::BIGINT AS total_documents, NULL::DOUBLE AS average_chunk_size, NULL::BIGINT AS total_embeddings,
  NULL::VARCHAR AS model_name, NULL::VARCHAR AS device
UNION ALL SELECT 'chunking', NULL, NULL, NULL, count(*), (SELECT count(*) FROM kept), round(avg(token_count), 2),
  NULL, NULL, NULL FROM cut
UNION ALL SELECT 'embedding', NULL, NULL, NULL, NULL, NULL, NULL, count(*), 'hashed-bag-of-words', 'cpu' FROM cut"""

# Stored side outputs hold what was written.
ORACLES["quarantine_stored"] = ORACLES["quarantine"]
ORACLES["metrics_exported"] = ORACLES["metrics_row"]

# What a delivery leaves does not depend on how it is stored.
ORACLES["snapshot_delivery"] = ORACLES["apply_changes"]
