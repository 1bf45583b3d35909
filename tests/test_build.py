"""Files to documents to chunks to vectors to answers, on small corpora of files."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lectern.operators import chunk, embed, metrics, parse, prompt
from lectern.plans import indexing, retrieval, stages
from lectern.sinks import tables as sink
from lectern.sources import files, tables


def write(folder, contents):
    for name, content in contents.items():
        path = os.path.join(folder, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as file:
            file.write(content if isinstance(content, bytes) else content.encode())
    return folder


def paged_reader():
    """Stands in for a reader of paged files: a header, then pages behind form feeds. Made inside a
    function, so that it travels to the workers by value."""

    def extract(content):
        if not content.startswith(b"%PDF"):
            raise ValueError("not a paged file")
        return [None if page == b"!" else page.decode() for page in content[4:].split(b"\f")[1:]]

    return extract


extractor = paged_reader()


def full_corpus():
    made = {f"doc{i}.txt": f"Document {i}\nLine two of {i}.\nLine three.\nEnd {i}." for i in range(50)}
    made |= {f"copy{i}.txt": made["doc0.txt"] for i in range(5)}
    made |= {f"blank{i}.pdf": b"%PDF\f" for i in range(40)}
    made |= {f"broken{i}.pdf": b"Not a valid PDF" for i in range(3)}
    return made | {"special_chars.txt": "Café €​ end", "whitespace.txt": "  a   b \n\n\n c  "}


def metric(row, *names):
    first = row.first()
    return tuple(first[name] for name in names)


COUNTS = ("documents_processed", "parse_failures", "duplicates_removed")


# ---- scans and parsing ---------------------------------------------------------------------------


def test_scans(spark, folder):
    write(folder, {"b.TXT": "x", "sub/c.md": "x", "e.csv": "x", "plain": "x", "sub/d.Pdf": "x", "f.log": "x"})

    def names(df):
        return sorted(os.path.basename(r["source_path"]) for r in df.select("source_path").collect())

    assert names(files.scan_corpus(spark, folder)) == ["b.TXT", "c.md", "d.Pdf", "f.log"]
    assert names(files.scan_corpus(spark, folder, files.PAGED_TYPES)) == ["d.Pdf"]
    assert names(files.scan_flat(spark, folder)) == ["b.TXT"]
    row = files.scan_corpus(spark, folder, ["txt"]).select("file_type", "file_size_bytes").first()
    assert tuple(row) == ("txt", 1)


def test_flat_scan_leaves_folders_named_like_partitions(spark, folder):
    write(folder, {"lang=en/a.txt": "x", "lang=fr/b.txt": "y", "_c.txt": "z", "other/d.txt": "w"})
    assert files.scan_flat(spark, folder).collect() == []
    write(folder, {"e.txt": "v", ".f.txt": "u"})
    assert [r["source_path"].rsplit("/", 1)[1] for r in files.scan_flat(spark, folder).collect()] == ["e.txt"]
    with pytest.raises(AnalysisException):
        files.scan_flat(spark, f"{folder}/nowhere")


def test_decoding(spark):
    cases = [
        (b"caf\xe9", "café"),
        ("café".encode(), "café"),
        (b"a\r\nb\rc\n", "a\nb\nc\n"),
        (b"\xed\xa0\x80", "\xed\xa0\x80"),
        (b"", ""),
    ]
    df = spark.createDataFrame([(i, bytearray(raw)) for i, (raw, _) in enumerate(cases)], "n int, content binary")
    rows = df.select("n", parse.decode_text("content").alias("text")).orderBy("n").collect()
    assert [r["text"] for r in rows] == [text for _, text in cases]


def test_parsing(spark, folder):
    write(
        folder,
        {"a.txt": "one", "b.pdf": b"%PDF\fp1\f\f!\fp4", "c.pdf": b"junk", "d.csv": "x"},
    )
    scanned = files.scan_corpus(spark, folder, ["txt", "pdf", "csv"])
    rows = {os.path.basename(r["source_path"]): r for r in parse.parse_files(scanned, extractor).collect()}
    assert (rows["a.txt"]["text"], rows["a.txt"]["page_count"]) == ("one", 1)
    assert (rows["b.pdf"]["text"], rows["b.pdf"]["page_count"]) == ("p1\np4", 4)
    assert rows["c.pdf"]["text"] is None and rows["c.pdf"]["page_count"] is None
    assert rows["c.pdf"]["error_message"] == "Unexpected error: not a paged file"
    assert rows["d.csv"]["error_message"] == "Unsupported file type: csv"
    assert {name for name, r in rows.items() if r["parse_success"]} == {"a.txt", "b.pdf"}
    kept = parse.with_placeholder(parse.parse_files(scanned.where("file_type <> 'csv'"), extractor)).collect()
    texts = {os.path.basename(r["source_path"]): r["text"] for r in kept}
    assert texts["c.pdf"] == "[PDF file: c.pdf - Error reading: Unexpected error: not a paged file]"


def test_paged_files_without_extractor_are_failures(spark, folder):
    write(folder, {"b.pdf": b"%PDF\fp1"})
    rows = parse.parse_files(files.scan_corpus(spark, folder)).collect()
    assert [r["parse_success"] for r in rows] == [False]


# ---- ingest --------------------------------------------------------------------------------------


def test_ingest_corrupted_file(spark, folder):
    raw = write(f"{folder}/raw", {"good.txt": "Herons wade at dawn", "bad.pdf": b"plain bytes", "blank.pdf": b"%PDF\f"})
    corpus = stages.Corpus(f"{folder}/out")
    row = stages.ingest(spark, raw, corpus, extractor)
    assert metric(row, *COUNTS) == (2, 1, 0)
    failed = spark.read.json(corpus.quarantine).collect()
    assert [os.path.basename(r["source_path"]) for r in failed] == ["bad.pdf"]
    assert failed[0]["error"] and failed[0]["timestamp"]


def test_ingest_documents_table(spark, folder):
    raw = write(f"{folder}/raw", {"a.txt": "Herons  wade", "b.txt": "Otters swim"})
    corpus = stages.Corpus(f"{folder}/out")
    stages.ingest(spark, raw, corpus)
    docs = tables.load_documents(spark, corpus.documents)
    assert [(f.name, f.dataType.simpleString()) for f in docs.schema] == [
        ("doc_id", "string"), ("source_path", "string"), ("text", "string"), ("hash", "string"),
        ("file_type", "string"), ("file_size_bytes", "bigint"), ("page_count", "int"),
        ("ingestion_timestamp", "timestamp"), ("parser_version", "string"),
    ]
    rows = docs.orderBy("source_path").collect()
    assert [r["text"] for r in rows] == ["Herons wade", "Otters swim"]
    for r in rows:
        assert len(r["doc_id"]) == 36 and r["doc_id"].count("-") == 4 and len(r["hash"]) == 64
        assert (r["file_type"], r["page_count"], r["parser_version"]) == ("txt", 1, "1.0.0")
        assert r["file_size_bytes"] > 0 and r["ingestion_timestamp"] is not None


def test_ingest_full_corpus_and_resume(spark, folder):
    made = full_corpus()
    assert len(made) == 100
    corpus, at = stages.Corpus(f"{folder}/out"), F.lit("2024-01-01").cast("timestamp")
    raw = write(f"{folder}/raw", made)
    row = stages.ingest(spark, raw, corpus, extractor, at=at)
    assert metric(row, *COUNTS) == (53, 3, 44)
    whole = sorted(tables.load_documents(spark, corpus.documents).collect())
    assert len(whole) == 53

    half = stages.Corpus(f"{folder}/half")
    first = write(f"{folder}/part/raw", {n: c for n, c in made.items() if n < "doc3"})
    stages.ingest(spark, first, half, extractor, at=at)
    before = tables.load_documents(spark, half.documents).count()
    write(f"{folder}/part/raw", made)
    stages.ingest(spark, first, half, extractor, at=at)
    stages.ingest(spark, first, half, extractor, at=at)
    after = tables.load_documents(spark, half.documents)
    assert before < after.count() == 53
    assert {r["hash"] for r in after.collect()} == {r["hash"] for r in whole}


def test_documents_files_are_bounded(spark, folder):
    docs = spark.range(25).selectExpr("id AS doc_id", "sha2(string(id), 256) AS hash").coalesce(1)
    sink.write_documents(docs, f"{folder}/docs", file_rows=10)
    sizes = spark.read.parquet(f"{folder}/docs").groupBy(F.input_file_name()).count().collect()
    assert sorted(r["count"] for r in sizes) == [5, 10, 10]


# ---- chunks and vectors --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def built(spark):
    import tempfile

    folder = tempfile.mkdtemp(prefix="lectern-test-")
    words = ["river", "stone", "cloud", "engine", "violin", "harbour", "lantern", "meadow"]
    texts = {
        f"d{i}.txt": f"About {words[i % 8]} and {words[(i + 3) % 8]}. " * (5 + i) + f"Number {i}." for i in range(24)
    }
    corpus = stages.Corpus(f"{folder}/out")
    stages.ingest(spark, write(f"{folder}/raw", texts), corpus)
    chunked = stages.chunk_corpus(spark, corpus, "fixed", size=200, overlap=20)
    embedded = stages.embed_corpus(spark, corpus, strategy="fixed")
    return corpus, chunked, embedded


def test_chunk_table(spark, built):
    corpus, row, _ = built
    assert os.path.isdir(f"{corpus.chunks}/chunking_strategy=fixed")
    stored = spark.read.parquet(corpus.chunks)
    assert set(stored.columns) == {
        "chunk_id", "doc_id", "chunk_text", "chunk_index", "char_start", "char_end", "token_count",
        "chunking_strategy", "source_path", "file_type", "ingestion_timestamp",
    }
    assert stored.where("source_path IS NULL OR file_type IS NULL").count() == 0
    total, docs, average = metric(row, "total_chunks", "total_documents", "average_chunk_size")
    assert (total, docs) == (stored.count(), 24)
    assert average == round(stored.agg(F.avg("token_count")).first()[0], 2)


def test_strategies_do_not_erase_each_other(spark, folder):
    docs = spark.createDataFrame([("a", "One. Two. Three."), ("b", "Four.")], "doc_id string, text string")
    for strategy in ("fixed", "semantic", "fixed"):
        sink.write_chunks(chunk.chunk_documents(docs, strategy), f"{folder}/chunks")
    counts = {r["chunking_strategy"]: r["count"] for r in spark.read.parquet(f"{folder}/chunks").groupBy("chunking_strategy").count().collect()}
    assert counts == {"fixed": 2, "semantic": 2}


def test_embedding_again_adds_nothing(spark, built):
    corpus, _, row = built
    before = spark.read.parquet(corpus.embeddings).count()
    assert metric(row, "total_embeddings") == (before,)
    again = stages.embed_corpus(spark, corpus, strategy="fixed")
    assert metric(again, "total_embeddings") == (before,)
    assert spark.read.parquet(corpus.embeddings).count() == before


def _same_vectors(spark, corpus):
    """Every stored chunk has the vector of its own text, and there are no others."""
    chunks = spark.read.parquet(corpus.chunks).select("chunk_id", "chunk_text")
    own = {r["chunk_id"]: r["embedding"] for r in embed.embed_hashed(chunks).collect()}
    stored = {r["chunk_id"]: r["embedding"] for r in spark.read.parquet(corpus.embeddings).collect()}
    assert stored == own
    return len(own)


@pytest.mark.parametrize("second", [(100, 10), (300, 30), (200, 20)])
def test_cutting_anew_leaves_no_vector_of_another_text(spark, folder, second):
    raw = write(f"{folder}/raw", {f"{n}.txt": f"Otters swim past mill number {n}. " * (n + 3) for n in range(12)})
    corpus = stages.Corpus(f"{folder}/out")
    stages.ingest(spark, raw, corpus)
    counts = []
    for size, overlap in ((200, 20), second, (200, 20)):
        stages.chunk_corpus(spark, corpus, size=size, overlap=overlap)
        stages.embed_corpus(spark, corpus)
        counts.append(_same_vectors(spark, corpus))
        indexing.build_index(spark, corpus, f"{folder}/index")
        assert indexing.load_index(spark, f"{folder}/index").entries.count() == counts[-1]
    assert counts[0] == counts[2]


def test_a_broken_run_keeps_its_finished_parts(spark, folder):
    raw = write(f"{folder}/raw", {f"{n}.txt": f"Otters swim past mill number {n}. " * 20 for n in range(12)})
    corpus = stages.Corpus(f"{folder}/out")
    stages.ingest(spark, raw, corpus)
    stages.chunk_corpus(spark, corpus, size=100, overlap=10)
    last = F.pmod(F.xxhash64("chunk_id"), F.lit(4)) == 3
    bad = spark.read.parquet(corpus.chunks).where(last).first()["chunk_text"]
    encoders = embed.Encoders()

    def encoder(fails):
        def make():
            def encode(texts):
                if fails and bad in texts:
                    raise ValueError("broken off")
                return [[float(len(t)), 1.0] for t in texts]

            return encode

        return make

    encoders.add("slow", encoder(True), 2)
    with pytest.raises(Exception, match="broken off"):
        stages.embed_corpus(spark, corpus, "slow", encoders, commits=4)
    chunks = spark.read.parquet(corpus.chunks).count()
    finished = {r["chunk_id"] for r in spark.read.parquet(corpus.embeddings).collect()}
    assert finished == {r["chunk_id"] for r in spark.read.parquet(corpus.chunks).where(~last).collect()}
    encoders.add("slow", encoder(False), 2)
    later = F.lit("2030-01-01").cast("timestamp")
    stages.embed_corpus(spark, corpus, "slow", encoders, commits=4, at=later)
    rows = spark.read.parquet(corpus.embeddings).collect()
    assert len(rows) == len({r["chunk_id"] for r in rows}) == chunks
    assert {r["chunk_id"] for r in rows if r["embedding_timestamp"].year < 2030} == finished
    positions = spark.read.parquet(corpus.positions).orderBy("embedding_index").collect()
    assert [r["embedding_index"] for r in positions] == list(range(chunks))
    assert [r["chunk_id"] for r in positions] == sorted(r["chunk_id"] for r in rows)


def test_changes_are_merged(spark, folder):
    raw = write(f"{folder}/raw", {f"{n}.txt": f"Otters swim past mill number {n}. " * 30 for n in range(6)})
    corpus = stages.Corpus(f"{folder}/out")
    stages.ingest(spark, raw, corpus)
    stages.chunk_corpus(spark, corpus)
    stages.embed_corpus(spark, corpus)
    second = write(f"{folder}/second", {f"{n}.txt": f"Otters swim past mill number {n}. " * 30 for n in range(1, 7)})
    write(second, {"2.txt": "Herons wade instead. " * 40})
    other = stages.Corpus(f"{folder}/other")
    stages.ingest(spark, second, other)
    moved = F.regexp_replace("source_path", "/second/", "/raw/")
    incoming = tables.load_documents(spark, other.documents).withColumn("source_path", moved)
    for _ in range(2):
        stages.apply_changes(spark, corpus, incoming)
        docs = tables.load_documents(spark, corpus.documents).collect()
        assert {(r["source_path"], r["hash"]) for r in docs} == {(r["source_path"], r["hash"]) for r in incoming.collect()}
        assert len(docs) == 6
        chunked = spark.read.parquet(corpus.chunks)
        assert {r["doc_id"] for r in chunked.collect()} == {r["doc_id"] for r in docs}
        assert _same_vectors(spark, corpus) == chunked.count()


def test_hashed_encoder_against_a_model(spark):
    import hashlib
    import re

    texts = ["to be or not to be", "", "Été 2024"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, chunk_text string")
    rows = embed.embed_hashed(df, dim=16).orderBy("n").collect()
    for row, text in zip(rows, texts):
        expected = [0.0] * 16
        for token in re.findall(r"\w+", text.lower()):
            expected[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 16] += 1
        assert row["embedding"] == expected


def failing_above(limit):
    def factory():
        def encode(texts):
            if len(texts) > limit:
                raise RuntimeError("CUDA out of memory")
            return [[float(len(t)), 1.0] for t in texts]

        return encode

    return factory


def test_encoder_backs_off_and_fails_at_one(spark):
    df = spark.range(40).selectExpr("string(id) AS chunk_id", "repeat('x', int(id)) AS chunk_text")
    rows = embed.embed_with(df, failing_above(4), 2).collect()
    assert {r["chunk_id"]: r["embedding"] for r in rows} == {str(i): [float(i), 1.0] for i in range(40)}
    with pytest.raises(Exception, match="out of memory"):
        embed.embed_with(df, failing_above(0), 2).collect()
    with pytest.raises(Exception, match="expected width 3"):
        embed.embed_with(df, failing_above(4), 3).collect()


def test_encoders_by_name(spark):
    known = embed.Encoders()
    known.add("lengths", failing_above(99), 2)
    df = spark.createDataFrame([("a", "xyz")], "chunk_id string, chunk_text string")
    row = known.embed(df, "lengths").first()
    assert (row["embedding"], row["model_name"], row["embedding_dim"]) == ([3.0, 1.0], "lengths", 2)
    assert known.embed(df, embed.HASHED).first()["embedding_dim"] == embed.HASHED_DIM
    with pytest.raises(ValueError):
        known.embed(df, "unknown")


def test_embedding_index(spark):
    df = spark.createDataFrame([(f"c{i:02}", "m", 2) for i in range(30)], "chunk_id string, model_name string, embedding_dim int")
    rows = embed.embedding_index(df.repartition(5), F.lit("now")).collect()
    assert sorted((r["embedding_index"], r["chunk_id"]) for r in rows) == [(i, f"c{i:02}") for i in range(30)]


# ---- index and retrieval -------------------------------------------------------------------------

ASKED = [(1, "river and engine"), (2, "violin meadow lantern"), (3, "number 7")]


@pytest.mark.parametrize("kind", indexing.INDEX_TYPES)
def test_index_and_retrieval(spark, built, folder, kind):
    corpus = built[0]
    queries = spark.createDataFrame(ASKED, "query_id long, query_text string")
    row = indexing.build_index(spark, corpus, f"{folder}/index", kind)
    total = spark.read.parquet(corpus.embeddings).count()
    assert metric(row, "total_vectors", "index_type") == (total, kind)
    index = indexing.load_index(spark, f"{folder}/index")
    assert tuple(index.stats().first()) == (total, kind, embed.HASHED_DIM)

    results = retrieval.retrieve(index, queries, 4)
    rows = results.orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"]) for r in rows] == [(q, n) for q, _ in ASKED for n in range(1, 5)]
    assert all(r["chunk_text"] and r["source_path"] and r["doc_id"] for r in rows)
    assert all(r["similarity_score"] == r["distance"] for r in rows)
    if kind == indexing.FLAT:
        texts = {r["rank"]: r["chunk_text"] for r in rows if r["query_id"] == 1}
        answer = prompt.extractive_answer(results).where("query_id = 1").first()["answer"]
        assert answer == "LLM not configured. Retrieved chunks:\n\n" + "\n\n".join(
            f"[{n}] {texts[n][:200]}..." for n in range(1, 5)
        )
        full = retrieval.respond(results, queries).where("query_id = 1").first()
        assert full["num_chunks_retrieved"] == 4
        assert [s["chunk_text"] for s in full["sources"]] == [texts[n] for n in range(1, 5)]
        assert full["prompt"].startswith("You are a helpful assistant") and full["prompt"].endswith("Answer:")
        assert f"[Document 2] (Source: {full['sources'][1]['source_path']})\n{texts[2]}\n\n[Document 3]" in full["prompt"]
        assert "User Question: river and engine\n" in full["prompt"]
    one = rows[0]["source_path"]
    only = retrieval.retrieve(index, queries, 2, {"source_path": [one]}).collect()
    assert {r["source_path"] for r in only} == {one}
    nothing = retrieval.retrieve(index, queries, 2, {"doc_type": "x"})
    assert nothing.count() == 0
    assert [tuple(r) for r in retrieval.outcome(nothing, queries, 0.0421, 1.2).orderBy("query_id").collect()] == [
        (q, 0, False, 42.1, 1200.0, 1242.1) for q, _ in ASKED
    ]
    after = retrieval.retrieve(index, queries, 2, {"source_path": [one]}, postfilter=True).collect()
    assert {r["source_path"] for r in after} <= {one}


def test_retrieval_bounds_and_missing_index(spark, built, folder):
    with pytest.raises(FileNotFoundError):
        indexing.load_index(spark, f"{folder}/nowhere")
    with pytest.raises(ValueError):
        indexing.build_index(spark, built[0], f"{folder}/index", "HNSW-like")
    for k in (0, 21):
        with pytest.raises(ValueError):
            prompt.check_top_k(k)


def test_missing_fields_get_defaults(spark):
    rows = [(1, 1, "c", None, None, None, 0.5)]
    results = spark.createDataFrame(
        rows,
        "query_id int, rank int, chunk_id string, chunk_text string, doc_id string, source_path string, similarity_score double",
    )
    source = prompt.source_list(results).first()["sources"][0]
    assert (source["chunk_text"], source["doc_id"], source["source_path"]) == ("", "", None)
    queries = spark.createDataFrame([(1, "q")], "query_id int, query_text string")
    assert "[Document 1] (Source: Unknown)\n\n" in prompt.format_prompt(results, queries).first()["prompt"]
    failed = prompt.error_answer(results, F.lit("boom")).first()["answer"]
    assert failed == "Error generating answer: boom\n\nRetrieved information:\n\n[1] ..."


def test_detect_changes(spark, built):
    corpus = built[0]
    stored = tables.load_documents(spark, corpus.documents)
    one = stored.agg(F.min("source_path")).first()[0]
    incoming = stored.where(F.col("source_path") != one)
    status = stages.detect_changes(spark, corpus, incoming).groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in status} == {"same": 23, "deleted": 1}


# ---- metrics -------------------------------------------------------------------------------------


def test_metrics_of_nothing(spark):
    none = spark.createDataFrame([], "parse_success boolean, hash string")
    assert metric(metrics.ingest_metrics(none, 0.0), *COUNTS, "documents_per_minute") == (0, 0, 0, 0.0)
    chunks = spark.createDataFrame([], "token_count int")
    row = metrics.chunk_metrics(chunks, none, 0.0)
    assert metric(row, "total_chunks", "average_chunk_size", "chunks_per_second") == (0, 0.0, 0.0)
    empty = spark.createDataFrame([], metrics.METRICS_SCHEMA)
    assert len(metrics.metrics_row(empty).columns) == 18
    assert set(metrics.metrics_row(empty).first()) == {0, 0.0, ""}
    assert {r["status"] for r in metrics.target_assessment(empty).collect()} == {"no data"}
    assert metrics.scale_projection(empty).count() == 0
    assert metrics.run_summary(empty).first()["total_seconds"] == 0.0


def test_metrics_are_counted_by_the_writing_jobs(spark, folder):
    """The same rows as from the stored tables, with copies, failures and a second, resumed run."""
    texts = {f"{i}.txt": f"text {i % 4}" for i in range(10)} | {"bad.pdf": "no reader"}
    corpus = stages.Corpus(f"{folder}/out")
    for _ in range(2):
        row = stages.ingest(spark, write(f"{folder}/raw", texts), corpus)
        assert metric(row, *COUNTS) == (4, 1, 6)
    documents = tables.load_documents(spark, corpus.documents)
    chunked = stages.chunk_corpus(spark, corpus, "fixed")
    again = metrics.chunk_metrics(spark.read.parquet(corpus.chunks), documents, 1.0)
    names = ("total_chunks", "total_documents", "average_chunk_size")
    assert metric(chunked, *names) == metric(again, *names)
    assert metric(stages.embed_corpus(spark, corpus), "total_embeddings") == (4,)


def test_stages_of_nothing_count_nothing(spark, folder):
    corpus = stages.Corpus(f"{folder}/out")
    assert metric(stages.ingest(spark, write(f"{folder}/raw", {"a.pdf": "no reader"}), corpus), *COUNTS) == (0, 1, 0)
    chunked = stages.chunk_corpus(spark, corpus, "fixed")
    assert metric(chunked, "total_chunks", "total_documents", "average_chunk_size") == (0, 0, 0.0)


def test_stored_metrics_and_export(spark, built, folder):
    corpus = built[0]
    stages_read = tables.load_metrics(spark, corpus.all_metrics)
    assert {"ingestion", "chunking", "embedding"} <= {r["stage"] for r in stages_read.collect()}
    assert tables.load_metrics(spark, f"{folder}/nowhere").count() == 0
    sink.write_csv(metrics.metrics_row(stages_read), f"{folder}/csv")
    back = spark.read.option("header", "true").csv(f"{folder}/csv").first()
    assert back["ingestion_docs"] == "24" and back["embedding_model"] == embed.HASHED
    summary = metrics.run_summary(stages_read).first()
    assert summary["documents"] == 24 and summary["embeddings_per_document"] == round(summary["embeddings"] / 24, 2)


@pytest.mark.parametrize("actual, status", [(800.0, "ok"), (799.0, "warn"), (500.0, "warn"), (499.0, "fail"), (0.0, "no data")])
def test_targets(spark, actual, status):
    row = spark.createDataFrame([(actual,)], "documents_per_minute double")
    found = metrics.target_assessment(metrics.stage_row("ingestion", row)).where("stage = 'ingestion'").first()
    assert found["status"] == status


def test_projection(spark):
    row = metrics.stage_row("embedding", spark.createDataFrame([(5.0,)], "chunks_per_second double"))
    amounts = {r["scale"]: (r["amount"], r["unit"]) for r in metrics.scale_projection(row).collect()}
    assert amounts == {"10k": (33.3, "minutes"), "100k": (333.3, "minutes"), "1M": (55.6, "hours")}
