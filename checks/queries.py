"""One query per operator. Each takes (session, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

import re
import uuid
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lectern.functions import ids, text as tx
from lectern.functions.vectors import squared_distance
from lectern.operators import (
    chunk,
    dedup,
    embed,
    filters,
    graph,
    ivf,
    lsh,
    metrics,
    nearest as nn,
    ordering,
    parse,
    prompt,
    requests as asking,
    search,
    tfidf,
)
from lectern.operators.rows import fits
from lectern.plans import indexing, retrieval, snapshots, stages
from lectern.plans.retrieval import outcome
from lectern.plans.stages import documents_to_chunks as clean_chunks
from lectern.session import COMPACT, shared_dir, stage
from lectern.sinks import tables as sink
from lectern.sources import files, tables
from lectern.sources.tables import read_table

# The elapsed seconds the metrics queries assume, since a result cannot depend on the clock.
INGEST_SECONDS, CHUNK_SECONDS, EMBED_SECONDS, INDEX_SECONDS = 50.0, 12.5, 80.0, 0.25

# Rows of three numbers that are sent to every task, within the bytes of any broadcast.
LABELS = 2_000_000

QUERIES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", list(columns) or None)


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as long, and floating point numbers as double, for the comparison."""
    wide = {T.IntegerType(): "long", T.FloatType(): "double"}
    return df.select(*[F.col(f.name).cast(wide.get(f.dataType, f.dataType)) for f in df.schema])


def dirty(column: str = "text") -> Column:
    """The text with the kinds of noise that normalisation removes, since the tables are clean."""
    marked = F.replace(F.col(column), F.lit(" "), F.lit(" \t "))
    marked = F.replace(marked, F.lit("."), F.lit(".\u200b\r\n\n "))
    return F.concat(F.lit("\u00a0  "), marked, F.lit(" \n"))


# ---- text ----------------------------------------------------------------------------------------


@query
def normalize_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", tx.normalize_text(dirty()).alias("text"))


@query
def content_hash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", tx.content_hash(tx.normalize_text(dirty())).alias("hash"))


@query
def assign_ids(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    path = F.concat_ws("/", "source", "doc_id")
    named = docs.select(
        "doc_id", "text", ids.document_id(path, tx.content_hash("text")).alias("document_id")
    )
    return named.select("doc_id", "document_id", ids.chunk_id("document_id", F.lit("fixed"), F.lit(0), tx.content_hash("text")).alias("first_chunk_id"))


@query
def token_count(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return plain(docs.select("doc_id", tx.word_count("text").alias("words"), tx.token_count("text").alias("tokens")))


@query
def tokenize(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", F.array_join(tx.tokens("text"), " ").alias("tokens"))


@query
def file_type(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return pages.select("page_id", "url", tx.file_type("url").alias("file_type"))


@query
def preview(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select(
        "doc_id",
        tx.preview("text", 300).alias("page_preview"),
        tx.preview("text", 80).alias("console_preview"),
        tx.preview("text", 200, always_mark=True).alias("answer_preview"),
    )


# ---- parsing -------------------------------------------------------------------------------------

EXTENSION_OF = {"en": "txt", "fr": "md", "de": "log"}


def _files(spark, sf_dir) -> DataFrame:
    """Every document as a file of its bytes; the type follows the language, one is unsupported."""
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "source", "text")
    kind = F.lit("csv")
    for lang, extension in EXTENSION_OF.items():
        kind = F.when(F.col("lang") == lang, extension).otherwise(kind)
    path = F.concat(F.col("source"), F.lit("/"), F.col("doc_id"), F.lit("."), kind)
    content = F.encode("text", "UTF-8")
    return docs.select(
        path.alias("source_path"),
        tx.file_type(path).alias("file_type"),
        F.octet_length(content).cast("long").alias("file_size_bytes"),
        content.alias("content"),
    )


@query
def decode_text(spark, sf_dir):
    """Half the languages stored as UTF-8 with Windows line ends, the others as Latin-1."""
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "text")
    lines = F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n"))
    narrow = F.regexp_replace(lines, "[^\\x00-\\xff]", "?")
    content = F.when(F.col("lang").isin("en", "fr"), F.encode(lines, "UTF-8")).otherwise(
        F.encode(narrow, "ISO-8859-1")
    )
    return docs.select("doc_id", parse.decode_text(content).alias("text"))


@query
def parse_dispatch(spark, sf_dir):
    return plain(parse.parse_files(_files(spark, sf_dir)))


@query
def quarantine(spark, sf_dir):
    failed = parse.failures(parse.parse_files(_files(spark, sf_dir)), F.lit("run-1"))
    return failed.select("source_path", "file_type", "error", F.col("timestamp").alias("run"))


@query
def quarantine_stored(spark, sf_dir):
    """As quarantine, from the JSON side output."""
    path = f"{shared_dir(spark).rstrip('/')}/quarantine-{uuid.uuid4().hex}"
    failed = parse.failures(parse.parse_files(_files(spark, sf_dir)), F.lit("run-1"))
    sink.write_json(failed, path)
    stored = spark.read.schema(failed.schema).json(path)
    return stored.select("source_path", "file_type", "error", F.col("timestamp").alias("run"))


@query
def scan_flat(spark, sf_dir):
    """Lines of the English texts, stored as files of a folder that has the other ones below it."""
    root = f"{shared_dir(spark).rstrip('/')}/flat-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents", "lang", "text")
    docs.where("lang = 'en'").select("text").write.option("maxRecordsPerFile", 1000).text(root)
    docs.where("lang <> 'en'").write.partitionBy("lang").text(f"{root}/others")
    lines = files.scan_flat(spark, root).select("file_type", F.explode(F.split(parse.decode_text("content"), "\n")).alias("line"))
    return lines.where("line <> ''").groupBy("file_type", "line").agg(F.count("*").alias("copies"))


@query
def parse_placeholder(spark, sf_dir):
    kept = parse.with_placeholder(parse.parse_files(_files(spark, sf_dir)))
    return kept.select("source_path", "text")


@query
def page_assemble(spark, sf_dir):
    """Lines stand for pages: empty ones are empty pages, ones without a full stop failed."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    pages = F.transform(
        F.split("text", "\n"),
        lambda page: F.when((page == "") | page.contains("."), page),
    )
    paged = docs.select("doc_id", pages.alias("pages"))
    return plain(paged.select("doc_id", F.size("pages").alias("page_count"), parse.join_pages("pages").alias("text")))


# ---- chunking ------------------------------------------------------------------------------------


def _chunks(spark, sf_dir, strategy="fixed", **options) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return chunk.chunk_documents(docs, strategy, **options)


def _without_ids(chunks: DataFrame) -> DataFrame:
    return plain(chunks.select("doc_id", "chunk_index", "char_start", "char_end", "chunk_text", "token_count"))


@query
def chunk_fixed(spark, sf_dir):
    return _without_ids(_chunks(spark, sf_dir))


@query
def chunk_fixed_100_10(spark, sf_dir):
    return _without_ids(_chunks(spark, sf_dir, size=100, overlap=10))


@query
def chunk_overlap_clamp(spark, sf_dir):
    return _without_ids(_chunks(spark, sf_dir, size=300, overlap=400))


@query
def chunk_sentence(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return plain(chunk.sentence_windows(docs))


@query
def chunk_strategies(spark, sf_dir):
    columns = ["chunk_id", "doc_id", "chunking_strategy", "chunk_index", "chunk_text"]
    fixed = _chunks(spark, sf_dir, "fixed").select(*columns)
    return plain(fixed.unionByName(_chunks(spark, sf_dir, "semantic").select(*columns)))


@query
def chunk_enrich(spark, sf_dir):
    """Fixed chunks with columns that ride along, and with their document's label where there is one."""
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "source", "text")
    chunks = chunk.chunk_documents(docs, carry=["lang", "source"])
    slim = chunks.select("doc_id", "chunk_index", "token_count", "lang", "source")
    return plain(chunk.enrich_chunks(slim, table(spark, sf_dir, "labels"), ["quality", "toxic"]))


# ---- duplicates, resume, order -------------------------------------------------------------------


def _hashed(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    clean = docs.withColumn("text", tx.normalize_text(dirty()))
    return clean.withColumn("hash", tx.content_hash("text"))


@query
def dedup_exact(spark, sf_dir):
    return dedup.drop_duplicates(_hashed(spark, sf_dir), "doc_id")


@query
def dedup_stats(spark, sf_dir):
    return dedup.duplicate_stats(_hashed(spark, sf_dir))


@query
def ingest_resume(spark, sf_dir):
    """What a rerun adds when the labelled documents are stored already."""
    incoming = _hashed(spark, sf_dir).select("doc_id", "hash")
    stored = incoming.join(table(spark, sf_dir, "labels", "doc_id"), "doc_id", "left_semi")
    return dedup.not_yet_stored(incoming, stored)


@query
def change_detect(spark, sf_dir):
    """Labelled documents are stored, those of bad quality in an older version; toxic ones vanish."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    version = F.when(F.col("quality") == 0, F.concat("text", F.lit(" old"))).otherwise(F.col("text"))
    labelled = docs.join(labels, "doc_id")
    stored = labelled.select("doc_id", tx.content_hash(version).alias("hash"))
    gone = labelled.where(F.col("toxic") == 1).select("doc_id")
    incoming = docs.join(gone, "doc_id", "left_anti").select("doc_id", tx.content_hash("text").alias("hash"))
    return dedup.changes(stored, incoming, "doc_id")


@query
def page_rows(spark, sf_dir):
    """The second hundred documents in id order."""
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "source")
    return ordering.page_of_rows(docs, "doc_id", offset=100, limit=100)


@query
def write_batches(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source")
    return ordering.write_batches(docs, "doc_id", batch_rows=300)


@query
def latest_checkpoint(spark, sf_dir):
    """Checkpoint names made of the document numbers, with names of other files among them."""
    docs = table(spark, sf_dir, "documents", "doc_id", "lang")
    prefix = F.when(F.col("lang") == "en", "checkpoint_").otherwise("part_")
    return metrics.latest_checkpoint(docs.select(F.concat(prefix, F.col("doc_id")).alias("name")))


# ---- TF-IDF --------------------------------------------------------------------------------------


def _documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def _questions(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return items.select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


@query
def term_frequency(spark, sf_dir):
    terms = tfidf.term_frequency(_documents(spark, sf_dir), ["doc_id"])
    return plain(terms.select("doc_id", "token", F.col("count").alias("term_count"), "total_tokens"))


@query
def document_frequency(spark, sf_dir):
    return tfidf.document_frequency(_documents(spark, sf_dir))


@query
def vocabulary(spark, sf_dir):
    return tfidf.vocabulary(_documents(spark, sf_dir))


@query
def idf(spark, sf_dir):
    scores = tfidf.inverse_document_frequency(_documents(spark, sf_dir))
    return scores.select("token", "df", F.round("idf", 9).alias("idf"))


@query
def idf_merged(spark, sf_dir):
    """Weights kept up to date: fitted without the documents of good quality, which then arrive, while toxic ones
    leave and those without a label change."""
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    docs = _documents(spark, sf_dir).join(labels, "doc_id", "left")
    good, toxic, changed = F.col("quality").eqNullSafe(1), F.col("toxic").eqNullSafe(1), F.col("quality").isNull()
    counts = stage(tfidf.token_counts(docs.where(~good)), "df")
    edited = F.when(changed, F.concat("text", F.lit(" edited"))).otherwise(F.col("text"))
    arriving = docs.where(~toxic & (good | changed)).withColumn("text", edited)
    leaving = docs.where(~good & (toxic | changed))
    merged = stage(tfidf.merged_counts(counts, arriving, leaving), "df")
    return tfidf.fitted(merged).select("token", "df", F.round("idf", 9).alias("idf"))


@query
def tfidf_vectors(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    weighted = tfidf.weights(
        tfidf.term_frequency(docs, ["doc_id"]), tfidf.inverse_document_frequency(docs), ["doc_id"]
    )
    return weighted.select("doc_id", "token", F.round("weight", 9).alias("weight"))


@query
def tfidf_topk(spark, sf_dir):
    """The flagship: the five sentence chunks most similar to every question, with their place."""
    chunks = chunk.sentence_windows(_documents(spark, sf_dir))
    found = tfidf.search(chunks, _questions(spark, sf_dir), ["doc_id", "chunk_index"], 5, "chunk_text")
    return plain(found.withColumn("similarity", F.round("similarity", 6)))


@query
def tfidf_index_topk(spark, sf_dir):
    """The same against a stored index of whole documents."""
    index = tfidf.build_index(_documents(spark, sf_dir), ["doc_id"])
    found = tfidf.search_index(index, _questions(spark, sf_dir), 5)
    return plain(found.withColumn("similarity", F.round("similarity", 6)))


# ---- embeddings ----------------------------------------------------------------------------------


def _as_text(vector: str) -> Column:
    return F.array_join(F.transform(vector, lambda x: x.cast("int").cast("string")), ",")


@query
def embed_input(spark, sf_dir):
    return _chunks(spark, sf_dir).select("chunk_id", "chunk_text")


@query
def embed_hashed(spark, sf_dir):
    vectors = embed.embed_hashed(_chunks(spark, sf_dir).select("chunk_id", "chunk_text"))
    return vectors.select("chunk_id", _as_text("embedding").alias("embedding"))


def _letters():
    """An encoder of three counts that has memory for no more than 16 texts at a time."""

    def encode(texts: list) -> list:
        if len(texts) > 16:
            raise MemoryError
        return [[len(t), t.count(" "), t.count("e")] for t in texts]

    return encode


@query
def embed_named(spark, sf_dir):
    """Vectors of an encoder added by name, whose batches are halved until they fit its memory."""
    encoders = embed.Encoders()
    encoders.add("letters", _letters, 3)
    embedded = encoders.embed(_chunks(spark, sf_dir).select("chunk_id", "chunk_text"), "letters")
    return plain(embedded.select("chunk_id", _as_text("embedding").alias("embedding"), "model_name", "embedding_dim"))


@query
def embed_resume(spark, sf_dir):
    """Chunks still to be embedded when the labelled documents' are stored, the rest by another model."""
    chunks = _chunks(spark, sf_dir).select("chunk_id", "doc_id")
    labelled = table(spark, sf_dir, "labels", "doc_id").withColumn("_labelled", F.lit(True))
    model = F.when(F.col("_labelled"), embed.HASHED).otherwise("other")
    stored = chunks.join(labelled, "doc_id", "left").select("chunk_id", model.alias("model_name"))
    return embed.not_yet_embedded(chunks, stored, embed.HASHED)


@query
def rechunk_resume(spark, sf_dir):
    """Vectors stored after the chunks were cut a second time: windows of 512, then of 300."""
    corpus = stages.Corpus(f"{shared_dir(spark).rstrip('/')}/rechunk-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    sink.write_documents(_as_documents(docs), corpus.documents)
    for size, overlap in ((512, 50), (300, 30)):
        stages.chunk_corpus(spark, corpus, "fixed", size=size, overlap=overlap)
        stages.embed_corpus(spark, corpus)
    stored = spark.read.parquet(corpus.embeddings).select("chunk_id", _as_text("embedding").alias("embedding"))
    return stored


def _as_documents(docs: DataFrame) -> DataFrame:
    """The documents table as a corpus stores it, texts as they are."""
    return docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.concat_ws("/", "source", "doc_id").alias("source_path"),
        "text",
        tx.content_hash(F.concat_ws("/", "doc_id", "text")).alias("hash"),  # every row of the table stays
        F.lit("txt").alias("file_type"),
        F.octet_length("text").cast("long").alias("file_size_bytes"),
        F.lit(1).alias("page_count"),
        F.lit(0).cast("timestamp").alias("ingestion_timestamp"),
        F.lit("1.0.0").alias("parser_version"),
    )


def _first_delivery(spark, sf_dir) -> tuple[stages.Corpus, DataFrame]:
    """A stored corpus with chunks and vectors, and the documents of the delivery that follows."""
    corpus = stages.Corpus(f"{shared_dir(spark).rstrip('/')}/changes-{uuid.uuid4().hex}")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    if (near := fits(labels, rows=LABELS)) and tables.spread(docs) is docs:
        docs = docs.join(F.broadcast(labels), "doc_id", "left")
    else:  # the texts are spread and meet their labels once, however often a delivery is read
        docs = tables.spread(docs).join(F.broadcast(labels) if near else labels, "doc_id", "left")
        docs = stage(docs, "deliveries", COMPACT)
    first = docs.where(~F.col("quality").eqNullSafe(1))
    edited = F.when(F.col("quality").isNull(), F.concat("text", F.lit(" edited"))).otherwise(F.col("text"))
    second = docs.where(~F.col("toxic").eqNullSafe(1)).withColumn("text", edited)
    sink.write_documents(_as_documents(first), corpus.documents)
    stages.chunk_corpus(spark, corpus, "fixed")
    stages.embed_corpus(spark, corpus)
    return corpus, _as_documents(second)


@query
def apply_changes(spark, sf_dir):
    """Chunks with vectors after a second delivery: good documents are new in it, toxic ones are gone, and
    those without a label have changed."""
    corpus, second = _first_delivery(spark, sf_dir)
    for _ in range(2):  # the second time changes nothing
        stages.apply_changes(spark, corpus, second)
    chunks = spark.read.parquet(corpus.chunks)
    vectors = spark.read.parquet(corpus.embeddings).select("chunk_id", _as_text("embedding").alias("embedding"))
    names = spark.read.parquet(corpus.documents).select("doc_id", "source_path")
    joined = chunks.select("chunk_id", "doc_id").join(names, "doc_id", "full").join(vectors, "chunk_id", "full")
    return joined.select("chunk_id", "doc_id", "source_path", "embedding")


@query
def snapshot_delivery(spark, sf_dir):
    """As apply_changes, from the second version of a corpus kept in versions."""
    corpus, second = _first_delivery(spark, sf_dir)
    root = f"{corpus.root}/kept"
    snapshots.deliver(spark, root, tables.load_documents(spark, corpus.documents))
    snapshots.deliver(spark, root, second)
    latest = snapshots.load_corpus(spark, root)
    chunks = spark.read.parquet(latest.chunks).select("chunk_id", "doc_id")
    vectors = snapshots.vectors(spark, latest).select("chunk_id", _as_text("embedding").alias("embedding"))
    names = spark.read.parquet(latest.documents).select("doc_id", "source_path")
    return chunks.join(names, "doc_id", "full").join(vectors, "chunk_id", "full").select("chunk_id", "doc_id", "source_path", "embedding")


@query
def embedding_index(spark, sf_dir):
    chunks = _chunks(spark, sf_dir).select(
        "chunk_id", F.lit(embed.HASHED).alias("model_name"), F.lit(embed.HASHED_DIM).alias("embedding_dim")
    )
    return plain(embed.embedding_index(chunks, F.lit("run-1")).withColumnRenamed("embedding_timestamp", "run"))


# ---- vector search -------------------------------------------------------------------------------


def _vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings", "vec_id", "embedding")


def _label_means(spark, sf_dir) -> DataFrame:
    """(label, mean): the mean vector of every label, from all vectors."""
    values = table(spark, sf_dir, "embeddings", "label", "embedding").select(
        "label", F.posexplode("embedding").alias("component", "value")
    )
    means = values.groupBy("label", "component").agg(F.avg(F.col("value").cast("double")).alias("value"))
    listed = F.sort_array(F.collect_list(F.struct("component", "value")))  # one row per component
    return means.groupBy("label").agg(listed.alias("_mean")).select("label", F.col("_mean.value").alias("mean"))


def _vector_queries(spark, sf_dir) -> DataFrame:
    """Every label asks for the vectors nearest to its mean."""
    asked = _label_means(spark, sf_dir).select(
        F.col("label").cast("long").alias("query_id"), F.col("mean").alias("query_vector")
    )
    return stage(asked, "asked")


def _rounded(found: DataFrame) -> DataFrame:
    return plain(found.withColumn("distance", F.round("distance", 6)))


@query
def knn_flat(spark, sf_dir):
    return _rounded(nn.nearest(_vectors(spark, sf_dir), _vector_queries(spark, sf_dir), 10))


@query
def vector_metadata(spark, sf_dir):
    """Nearest neighbours with the label of the document of the same number, where there is one."""
    found = nn.nearest(_vectors(spark, sf_dir), _vector_queries(spark, sf_dir), 3)
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "vec_id")
    joined = search.with_metadata(found, labels)
    return plain(joined.select("query_id", "rank", "vec_id", "quality", "toxic"))


def _entries(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")


@query
def knn_filtered(spark, sf_dir):
    """Which vectors pass each kind of filter; the quality is null where there is no label."""
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "vec_id")
    entries = _entries(spark, sf_dir).select("vec_id", "label").join(labels, "vec_id", "left")
    kinds = {
        "equal": {"label": 3},
        "member": {"label": [1, 4, 7]},
        "both": {"label": [1, 4, 7], "quality": 1},
        "empty_list": {"label": []},
        "unknown_key": {"source": "web"},
        "none": {"quality": None},
        "other_type": {"label": "3"},
        "mixed_list": {"label": [3, "x", 4.0, 4.5]},
        "no_filter": None,
    }
    return entries.select(
        "vec_id",
        *[filters.matches(entries, wanted).alias(name) for name, wanted in kinds.items()],
    )


@query
def knn_prefilter(spark, sf_dir):
    found = search.search_prefiltered(
        _entries(spark, sf_dir), _vector_queries(spark, sf_dir), 5, {"label": [2, 5]}
    )
    return _rounded(found)


@query
def knn_postfilter(spark, sf_dir):
    found = search.search_postfiltered(
        _entries(spark, sf_dir), _vector_queries(spark, sf_dir), 5, {"label": [2, 5]}
    )
    return _rounded(found)


@query
def ivf_params(spark, sf_dir):
    return ivf.parameters(_vectors(spark, sf_dir))


def _seeded(spark, sf_dir) -> tuple[DataFrame, DataFrame, int]:
    vectors = _vectors(spark, sf_dir)
    lists = ivf.list_count(vectors.count())
    return vectors, stage(ivf.seed_centroids(vectors, lists), "centroids"), lists


@query
def ivf_assign(spark, sf_dir):
    vectors, centroids, _ = _seeded(spark, sf_dir)
    return plain(ivf.assign(vectors, centroids))


@query
def knn_ivf(spark, sf_dir):
    """Three of the lists are searched, so that the result differs from the exact one."""
    vectors, centroids, _ = _seeded(spark, sf_dir)
    lists = ivf.build_lists(vectors, centroids)
    return _rounded(ivf.search(lists, centroids, _vector_queries(spark, sf_dir), 10, nprobe=3))


@query
def knn_ivf_trained(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    centroids = stage(ivf.train_centroids(vectors, ivf.list_count(vectors.count())), "centroids")
    lists = stage(ivf.build_lists(vectors, centroids), "lists")
    return _rounded(ivf.search(lists, centroids, _vector_queries(spark, sf_dir), 10))


def _trained_lists(spark, sf_dir, *columns: str) -> tuple[DataFrame, DataFrame]:
    """All vectors in the lists of trained centroids, and the lists with their extents."""
    vectors = _vectors(spark, sf_dir)
    if columns:
        vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding", *columns)
    centroids = stage(ivf.train_centroids(vectors, ivf.list_count(vectors.count())), "centroids")
    placed = stage(ivf.with_list(vectors, centroids), "lists")
    return placed, stage(centroids.join(ivf.list_extents(placed), "list_id"), "extents")


@query
def knn_ivf_exact(spark, sf_dir):
    """The nearest vectors from inverted lists, read in the order of their bounds until no list can hold more."""
    lists, extents = _trained_lists(spark, sf_dir)
    found = ivf.search_exact(lists, extents, _vector_queries(spark, sf_dir), 10)
    return _rounded(found.drop("lists_read"))


@query
def knn_ivf_filtered(spark, sf_dir):
    """As knn_prefilter, inside the lists: further ones are read until five matching vectors are certain."""
    lists, extents = _trained_lists(spark, sf_dir, "label")
    matching = lists.where(filters.matches(lists, {"label": [2, 5]}))
    found = ivf.search_exact(matching, extents, _vector_queries(spark, sf_dir), 5, first_probes=1)
    return _rounded(found.drop("lists_read").join(lists.select("vec_id", "label"), "vec_id"))


@query
def ivf_extents(spark, sf_dir):
    """How many vectors each list holds, and how near and far they lie to its centroid."""
    vectors, centroids, _ = _seeded(spark, sf_dir)
    extents = ivf.list_extents(ivf.with_list(vectors, centroids))
    return plain(extents.select("list_id", "size", F.round("near", 6).alias("near"), F.round("far", 6).alias("far")))


@query
def knn_lsh(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    shape = lsh.Shape(64, lsh.bucket_width(vectors), projections=lsh.projections_for(vectors.count()))
    placed = lsh.with_lists(vectors, "embedding", shape)
    return _rounded(lsh.search(placed, _vector_queries(spark, sf_dir), 10, shape))


@query
def knn_graph(spark, sf_dir):
    """From a neighbour graph over all vectors, searched in bounded steps."""
    found = graph.search(graph.build_graph(_vectors(spark, sf_dir)), _vector_queries(spark, sf_dir), 10)
    return _rounded(found.drop("looked_at"))


@query
def recall_at_k(spark, sf_dir):
    vectors, centroids, _ = _seeded(spark, sf_dir)
    asked = _vector_queries(spark, sf_dir)
    approximate = ivf.search(ivf.build_lists(vectors, centroids), centroids, asked, 10, nprobe=3)
    return search.recall(nn.nearest(vectors, asked, 10), approximate, 10)


@query
def pair_distance(spark, sf_dir):
    """Distance of every vector to the mean vector of its label, as a column expression."""
    distance = F.round(squared_distance("embedding", "mean"), 6)
    means = _label_means(spark, sf_dir)
    return _entries(spark, sf_dir).join(means, "label").select("vec_id", distance.alias("distance"))


@query
def index_validate(spark, sf_dir):
    """The labels table plays the metadata, so some vectors have none and some rows no vector. Some
    vectors come twice, and some are infinite."""
    labels = table(spark, sf_dir, "labels", "doc_id").withColumnRenamed("doc_id", "vec_id")
    vectors = _vectors(spark, sf_dir)
    infinite = vectors.where("vec_id % 200 = 0").select(
        (-1 - F.col("vec_id")).alias("vec_id"),
        F.transform("embedding", lambda x: F.lit(float("inf")).cast("float")).alias("embedding"),
    )
    given = vectors.unionByName(vectors.where("vec_id % 100 = 0")).unionByName(infinite)
    return search.validate(given, labels, 64)


@query
def index_stats(spark, sf_dir):
    return plain(search.stats(_vectors(spark, sf_dir), "Flat"))


# ---- retrieval to prompt -------------------------------------------------------------------------


def _retrieved(spark, sf_dir, k: int = 5) -> DataFrame:
    """The chunks nearest to every question in the hashed embedding, with text and document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    chunks = chunk.chunk_documents(docs, carry=["source"])
    metadata = chunks.select(
        F.col("chunk_id").alias("vec_id"), "chunk_text", "doc_id", F.col("source").alias("source_path")
    )
    vectors = embed.embed_hashed(metadata.select("vec_id", "chunk_text"), "chunk_text").drop("chunk_text")
    asked = embed.embed_hashed(_questions(spark, sf_dir), "query_text", "query_vector").drop("query_text")
    found = search.with_metadata(nn.nearest(vectors, stage(asked, "asked"), k), metadata)
    return search.with_similarity(found).withColumnRenamed("vec_id", "chunk_id")


@query
def batch_retrieve(spark, sf_dir):
    found = _retrieved(spark, sf_dir)
    return plain(found.select("query_id", "rank", "chunk_id", "doc_id", "source_path", "chunk_text", "similarity_score"))


def _embedded_corpus(spark, sf_dir, commits: int = 1) -> stages.Corpus:
    """The documents as a stored corpus with fixed chunks and their vectors."""
    corpus = stages.Corpus(f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}")
    docs = _as_documents(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    sink.write_documents(docs.withColumn("source_path", F.element_at(F.split("source_path", "/"), 1)), corpus.documents)
    stages.chunk_corpus(spark, corpus, "fixed")
    stages.embed_corpus(spark, corpus, commits=commits)
    return corpus


def _index(spark, sf_dir, index_type: str):
    """A stored index over the fixed chunks of the documents, built and loaded as a user does."""
    corpus = _embedded_corpus(spark, sf_dir)
    indexing.build_index(spark, corpus, f"{corpus.root}/index", index_type)
    return indexing.load_index(spark, f"{corpus.root}/index")


@query
def stored_positions(spark, sf_dir):
    """The position table that embedding in three commits leaves behind."""
    positions = spark.read.parquet(_embedded_corpus(spark, sf_dir, commits=3).positions)
    return plain(positions.select("chunk_id", "embedding_index", "model_name", "embedding_dim"))


@query
def retrieve_index(spark, sf_dir):
    """As batch_retrieve, from a stored index."""
    found = retrieval.retrieve(_index(spark, sf_dir, indexing.FLAT), _questions(spark, sf_dir))
    found = found.withColumn("doc_id", F.col("doc_id").cast("long"))
    return plain(found.select("query_id", "rank", "chunk_id", "doc_id", "source_path", "chunk_text", "similarity_score"))


def _requests(spark, sf_dir) -> DataFrame:
    """The questions as requests: each with its own number of results, some out of range, and its own filters."""
    wanted = [
        None,
        '{"source_path": ["src3", "src8"]}',
        '{"chunk_index": [0, 2], "file_type": "txt"}',
        '{"source_path": "src5", "chunk_index": 0}',
        '{"doc_type": "x"}',
        '["not an object"]',
    ]
    kinds = F.element_at(F.array(*[F.lit(w) for w in wanted]), (F.col("query_id") % len(wanted) + 1).cast("int"))
    top_k = F.when(F.col("query_id") % 22 != 5, F.col("query_id") % 22)
    return _questions(spark, sf_dir).withColumns({"top_k": top_k, "filters": kinds})


def _answered(spark, sf_dir, index_type: str) -> DataFrame:
    found, _ = retrieval.retrieve_requests(_index(spark, sf_dir, index_type), _requests(spark, sf_dir))
    return plain(found.select("query_id", "rank", "chunk_id", "source_path", "chunk_index", "similarity_score"))


@query
def retrieve_requests(spark, sf_dir):
    """Requests with their own top k and filters against a stored flat index."""
    return _answered(spark, sf_dir, indexing.FLAT)


@query
def retrieve_requests_lists(spark, sf_dir):
    """The same, from inverted lists: further lists are read until each request's k matches are certain."""
    return _answered(spark, sf_dir, indexing.INVERTED)


@query
def requests_rejected(spark, sf_dir):
    """Requests whose top k is out of range or whose filters are no object, with the reason."""
    return asking.rejected(_requests(spark, sf_dir))


def _merged_index(spark, sf_dir, index_type: str) -> indexing.Index:
    """An index of the first delivery that was brought in line with a second one (as in apply_changes)."""
    corpus, second = _first_delivery(spark, sf_dir)
    indexing.build_index(spark, corpus, f"{corpus.root}/index", index_type)
    stages.apply_changes(spark, corpus, second)
    return indexing.merge_index(spark, corpus, f"{corpus.root}/index")


@query
def merge_index(spark, sf_dir):
    """The five chunks nearest to every question in inverted lists after a merged delivery."""
    index = _merged_index(spark, sf_dir, indexing.INVERTED)
    asked = retrieval.embed_queries(_questions(spark, sf_dir), index.model_name)
    found = index.search(asked, 5, exact=True)
    return plain(found.select("query_id", "rank", F.col("vec_id").alias("chunk_id"), "source_path", "chunk_text", "similarity_score"))


@query
def merged_entries(spark, sf_dir):
    """Every live entry of a flat index after the merge, with its metadata."""
    index = _merged_index(spark, sf_dir, indexing.FLAT)
    return plain(index.entries.select(F.col("vec_id").alias("chunk_id"), "doc_id", "source_path", "chunk_index", "token_count", _as_text("embedding").alias("embedding")))


@query
def respond_index(spark, sf_dir):
    """Prompt and answer of every question, from a stored index."""
    questions = _questions(spark, sf_dir)
    found = stage(retrieval.retrieve(_index(spark, sf_dir, indexing.FLAT), questions), "results")
    answers = retrieval.respond(found, questions)
    return plain(answers.select("query_id", "num_chunks_retrieved", "prompt", "answer"))


def _write_raw(spark, sf_dir, root: str) -> None:
    """Every text as a file of its own, in a folder per source. A folder per file would take as many steps of the
    driver to commit and to list; Spark's writer starts a program per file of a local disk (to set its mode), so that
    there workers write the files."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("source", F.col("text").cast("binary").alias("text"))
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if (root if re.match(r"\w+:", root) else default).startswith("file:"):
        _write_files(docs, re.sub(r"\Afile:/*", "/", root))
    else:
        direct = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}  # tasks put their files in place themselves
        docs = docs.withColumn("text", F.col("text").cast("string"))
        docs.write.partitionBy("source").option("maxRecordsPerFile", 1).options(**direct).text(root)


def _write_files(docs: DataFrame, root: str) -> None:
    """Rows (source, text) of a scan as local files, named by task and row: a task that runs again writes the same ones
    over. They appear under their name when they are complete."""

    def write(batches):
        store, task, rows, made = fs.LocalFileSystem(), TaskContext.get(), 0, {}
        for batch in batches:
            for source, text in ((a.as_py(), b.as_py()) for a, b in zip(*batch.columns, strict=True)):
                if source not in made:
                    folder = quote(source, safe="") if source else "__HIVE_DEFAULT_PARTITION__"
                    made[source] = f"{root}/source={folder}"
                    store.create_dir(made[source], recursive=True)
                name = f"part-{task.partitionId():05}-{rows:07}.txt"
                with store.open_output_stream(hidden := f"{made[source]}/.{task.taskAttemptId()}-{name}") as file:
                    file.write((text or b"") + b"\n")
                store.move(hidden, f"{made[source]}/{name}")
                rows += 1
        yield pa.RecordBatch.from_pydict({"files": [rows]})

    fs.LocalFileSystem().create_dir(root, recursive=True)
    docs.mapInArrow(write, "files long").agg(F.sum("files")).first()


@query
def ingest_files(spark, sf_dir):
    """The texts as files of a folder tree, scanned, decoded, normalised and stored without copies."""
    root = f"{shared_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"
    _write_raw(spark, sf_dir, f"{root}/raw")
    corpus = stages.Corpus(f"{root}/corpus")
    stages.ingest(spark, f"{root}/raw", corpus)
    stored = tables.load_documents(spark, corpus.documents)
    return plain(stored.select("hash", "text", "file_type", "page_count", "parser_version"))


@query
def source_list(spark, sf_dir):
    """The list of a query's sources, written as one text per query."""
    listed = prompt.source_list(_retrieved(spark, sf_dir))
    line = F.transform(
        "sources",
        lambda s: F.concat_ws("|", s["rank"], s["chunk_id"], s["doc_id"], s["source_path"], s["similarity_score"].cast("int")),
    )
    return plain(listed.select("query_id", F.array_join(line, ";").alias("sources"), "num_chunks_retrieved"))


@query
def retrieval_outcome(spark, sf_dir):
    """Results found per question among the chunks of labelled documents of good quality."""
    found = _retrieved(spark, sf_dir).select("query_id", "doc_id")
    good = table(spark, sf_dir, "labels", "doc_id", "quality").where("quality = 1").select("doc_id")
    kept = found.join(good, "doc_id", "left_semi")
    return outcome(kept, _questions(spark, sf_dir), 0.0421, 1.2)


@query
def format_prompt(spark, sf_dir):
    return prompt.format_prompt(_retrieved(spark, sf_dir), _questions(spark, sf_dir))


@query
def extractive_answer(spark, sf_dir):
    return prompt.extractive_answer(_retrieved(spark, sf_dir))


@query
def error_answer(spark, sf_dir):
    return prompt.error_answer(_retrieved(spark, sf_dir), F.lit("timeout"))


# ---- metrics and reports -------------------------------------------------------------------------


def _ingested(spark, sf_dir) -> DataFrame:
    return parse.normalized(parse.parse_files(_files(spark, sf_dir))).select("parse_success", "hash")


@query
def ingest_metrics(spark, sf_dir):
    return metrics.ingest_metrics(_ingested(spark, sf_dir), INGEST_SECONDS)


@query
def chunk_metrics(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id")
    return metrics.chunk_metrics(_chunks(spark, sf_dir), docs, CHUNK_SECONDS)


@query
def embed_metrics(spark, sf_dir):
    return metrics.embed_metrics(_chunks(spark, sf_dir), embed.HASHED, "cpu", EMBED_SECONDS)


@query
def corpus_stats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    chunks = chunk.sentence_windows(docs, carry=["source"])
    return chunks.agg(F.count("*").alias("chunks"), F.countDistinct("source").alias("sources"))


def _stages(spark, sf_dir) -> DataFrame:
    rows = {
        "ingestion": ingest_metrics(spark, sf_dir),
        "chunking": chunk_metrics(spark, sf_dir),
        "embedding": embed_metrics(spark, sf_dir),
        "vector_store": metrics.index_metrics(_vectors(spark, sf_dir), "Flat", INDEX_SECONDS),
    }
    stacked = None
    for name, row in rows.items():
        one = metrics.stage_row(name, row)
        stacked = one if stacked is None else stacked.unionByName(one)
    return stacked


@query
def run_summary(spark, sf_dir):
    return metrics.run_summary(_stages(spark, sf_dir))


@query
def metrics_row(spark, sf_dir):
    return plain(metrics.metrics_row(_stages(spark, sf_dir)))


@query
def metrics_exported(spark, sf_dir):
    """As metrics_row, from the exported CSV with its header."""
    path = f"{shared_dir(spark).rstrip('/')}/export-{uuid.uuid4().hex}"
    row = metrics_row(spark, sf_dir)
    sink.write_csv(row, path)
    return spark.read.option("header", "true").schema(row.schema).csv(path)


@query
def stage_metrics(spark, sf_dir):
    """What the stages from files to vectors counted while they wrote, read from beside their tables."""
    root = f"{shared_dir(spark).rstrip('/')}/stages-{uuid.uuid4().hex}"
    _write_raw(spark, sf_dir, f"{root}/raw")
    corpus = stages.Corpus(f"{root}/corpus")
    stages.ingest(spark, f"{root}/raw", corpus)
    stages.chunk_corpus(spark, corpus, "fixed")
    stages.embed_corpus(spark, corpus)
    timed = [c for c in metrics.METRICS_SCHEMA.replace(",", "").split()[::2] if "second" in c or "minute" in c]
    return plain(tables.load_metrics(spark, corpus.all_metrics).drop(*timed, "total_vectors", "index_type"))


@query
def target_assessment(spark, sf_dir):
    return metrics.target_assessment(_stages(spark, sf_dir))


@query
def scale_projection(spark, sf_dir):
    return metrics.scale_projection(_stages(spark, sf_dir))


# ---- whole stages --------------------------------------------------------------------------------


@query
def documents_to_chunks(spark, sf_dir):
    """Normalise, drop duplicates, chunk and carry the document's columns, in one plan."""
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "source", "text")
    chunks = clean_chunks(docs.withColumn("text", dirty()), carry=["hash", "lang", "source"])
    return plain(chunks)
