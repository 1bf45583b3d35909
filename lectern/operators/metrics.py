"""Run metrics: one row per stage, their roll-up, targets and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Targets with their units, thresholds in percent, scales of the projection, and the
# columns of the exported row with the stage and metric they come from and their defaults.
TARGETS = [("ingestion", 1000.0, "docs/min"), ("chunking", 5000.0, "chunks/sec"), ("embedding", 200.0, "chunks/sec")]
TARGET_REACHED, TARGET_NEAR = 80.0, 50.0
SCALES = [("10k", 10_000, "minutes", 60.0), ("100k", 100_000, "minutes", 60.0), ("1M", 1_000_000, "hours", 3600.0)]
EXPORT_COLUMNS = [
    ("ingestion_docs", "ingestion", "documents_processed", 0),
    ("ingestion_failures", "ingestion", "parse_failures", 0),
    ("ingestion_duplicates", "ingestion", "duplicates_removed", 0),
    ("ingestion_time_s", "ingestion", "processing_time_seconds", 0.0),
    ("ingestion_throughput", "ingestion", "documents_per_minute", 0.0),
    ("chunking_chunks", "chunking", "total_chunks", 0),
    ("chunking_docs", "chunking", "total_documents", 0),
    ("chunking_avg_size", "chunking", "average_chunk_size", 0.0),
    ("chunking_time_s", "chunking", "processing_time_seconds", 0.0),
    ("chunking_throughput", "chunking", "chunks_per_second", 0.0),
    ("embedding_count", "embedding", "total_embeddings", 0),
    ("embedding_model", "embedding", "model_name", ""),
    ("embedding_device", "embedding", "device", ""),
    ("embedding_time_s", "embedding", "processing_time_seconds", 0.0),
    ("embedding_throughput", "embedding", "chunks_per_second", 0.0),
    ("vector_store_vectors", "vector_store", "total_vectors", 0),
    ("vector_store_type", "vector_store", "index_type", ""),
    ("vector_store_build_time_s", "vector_store", "build_time_seconds", 0.0),
]

# Stage metrics have one schema, so that the stages stack and a missing stage is simply no row.
METRICS_SCHEMA = (
    "stage string, documents_processed long, parse_failures long, duplicates_removed long, "
    "documents_per_minute double, total_chunks long, total_documents long, average_chunk_size double, "
    "chunks_per_second double, total_embeddings long, model_name string, device string, "
    "total_vectors long, index_type string, processing_time_seconds double, build_time_seconds double"
)


def rate(amount: Column, seconds: Column, per: float = 1.0) -> Column:
    """Amount per second (or per ``per`` seconds), two decimals; 0 if no time passed."""
    return F.when(seconds > 0, F.round(F.try_divide(amount.cast("double"), seconds) * per, 2)).otherwise(0.0)


def ingest_metrics(parsed: DataFrame, seconds: float) -> DataFrame:
    """One row from (parse_success, hash) rows: kept documents, failures, duplicates, docs per minute."""
    per_hash = parsed.groupBy("parse_success", "hash").agg(F.count("*").alias("_copies"))
    ok = F.col("parse_success")
    counts = per_hash.agg(
        F.count_if(ok).alias("documents_processed"),
        F.coalesce(F.sum(F.when(~ok, F.col("_copies"))), F.lit(0)).alias("parse_failures"),
        F.coalesce(F.sum(F.when(ok, F.col("_copies") - 1)), F.lit(0)).alias("duplicates_removed"),
    )
    return ingest_row(counts, seconds)


def ingest_row(counts: DataFrame, seconds: float) -> DataFrame:
    """The metrics row from the counts of kept documents, failures and duplicates."""
    elapsed = F.lit(float(seconds))
    return counts.select(
        "*",
        F.round(elapsed, 2).alias("processing_time_seconds"),
        rate(F.col("documents_processed"), elapsed, 60.0).alias("documents_per_minute"),
    )


def chunk_metrics(chunks: DataFrame, documents: DataFrame, seconds: float) -> DataFrame:
    """One row: chunks, documents, average token count, chunks per second."""
    counts = chunks.agg(*chunk_counts())
    return chunk_row(counts.withColumn("total_documents", documents.agg(F.count("*")).scalar()), seconds)


def chunk_counts() -> list[Column]:
    """Aggregates over chunk rows: how many, and their average token count."""
    average = F.coalesce(F.round(F.avg("token_count"), 2), F.lit(0.0))
    return [F.count(F.lit(1)).alias("total_chunks"), average.alias("average_chunk_size")]


def chunk_row(counts: DataFrame, seconds: float) -> DataFrame:
    """The metrics row from the counts of chunks and documents and the average token count."""
    elapsed = F.lit(float(seconds))
    return counts.select(
        "total_chunks",
        "total_documents",
        "average_chunk_size",
        F.round(elapsed, 2).alias("processing_time_seconds"),
        rate(F.col("total_chunks"), elapsed).alias("chunks_per_second"),
    )


def embed_metrics(embedded: DataFrame, model_name: str, device: str, seconds: float) -> DataFrame:
    """One row: vectors, model, chunks per second."""
    return embed_row(embedded.agg(F.count("*").alias("total_embeddings")), model_name, device, seconds)


def embed_row(counts: DataFrame, model_name: str, device: str, seconds: float) -> DataFrame:
    """The metrics row from the count of vectors."""
    elapsed = F.lit(float(seconds))
    return counts.select(
        "total_embeddings",
        F.lit(model_name).alias("model_name"),
        F.lit(device).alias("device"),
        F.round(elapsed, 2).alias("processing_time_seconds"),
        rate(F.col("total_embeddings"), elapsed).alias("chunks_per_second"),
    )


def index_metrics(vectors: DataFrame, index_type: str, seconds: float) -> DataFrame:
    """One row: vectors, index type, build time."""
    return vectors.agg(F.count("*").alias("total_vectors")).select(
        "total_vectors",
        F.lit(index_type).alias("index_type"),
        F.round(F.lit(float(seconds)), 2).alias("build_time_seconds"),
    )


def observed(spark: SparkSession, **values: int | float) -> DataFrame:
    """One row of values that a write job has counted on its way."""
    kinds = ", ".join(f"{name} {'double' if isinstance(value, float) else 'long'}" for name, value in values.items())
    return spark.createDataFrame([tuple(values.values())], kinds)


def stage_row(stage: str, metrics: DataFrame) -> DataFrame:
    """A metrics row of one stage in the common schema."""
    wanted = [field.split() for field in METRICS_SCHEMA.split(", ")]
    known = {"stage": F.lit(stage), **{name: F.col(name) for name in metrics.columns}}
    return metrics.select(
        *[known.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in wanted]
    )


def _metric(stage: str, name: str) -> Column:
    """The value of a metric in the row of its stage, for use in an aggregation over stage rows."""
    return F.max(F.when(F.col("stage") == stage, F.col(name)))


def run_summary(stages: DataFrame) -> DataFrame:
    """One row: total time over the stages, embeddings and chunks per document where there are any."""
    gathered = stages.agg(
        F.coalesce(
            F.sum(F.coalesce("processing_time_seconds", "build_time_seconds", F.lit(0.0))), F.lit(0.0)
        ).alias("total_seconds"),
        _metric("ingestion", "documents_processed").alias("documents"),
        _metric("embedding", "total_embeddings").alias("embeddings"),
        _metric("chunking", "total_chunks").alias("chunks"),
        _metric("chunking", "total_documents").alias("chunked_documents"),
    )

    def per(amount: str, documents: str) -> Column:
        ratio = F.try_divide(F.col(amount).cast("double"), F.col(documents))
        return F.when(F.col(documents) > 0, F.round(ratio, 2))

    return gathered.select(
        F.round("total_seconds", 2).alias("total_seconds"),
        F.round(F.col("total_seconds") / 60.0, 2).alias("total_minutes"),
        "documents",
        "embeddings",
        per("embeddings", "documents").alias("embeddings_per_document"),
        per("chunks", "chunked_documents").alias("chunks_per_document"),
    )


def target_assessment(stages: DataFrame) -> DataFrame:
    """(stage, actual, target, unit, percent, status) of the stages that have a target."""
    spark = stages.sparkSession
    targets = spark.createDataFrame(TARGETS, "stage string, target double, unit string")
    measured = stages.select(
        "stage",
        F.when(F.col("stage") == "ingestion", F.col("documents_per_minute"))
        .otherwise(F.col("chunks_per_second"))
        .alias("actual"),
    )
    percent = F.col("actual") / F.col("target") * 100.0
    status = (
        F.when(F.col("actual") <= 0, "no data")
        .when(percent >= TARGET_REACHED, "ok")
        .when(percent >= TARGET_NEAR, "warn")
        .otherwise("fail")
    )
    return (
        targets.join(measured, "stage", "left")
        .withColumn("actual", F.coalesce("actual", F.lit(0.0)))
        .select(
            "stage",
            F.round("actual", 2).alias("actual"),
            "target",
            "unit",
            F.when(F.col("actual") > 0, F.round(percent, 1)).alias("percent"),
            status.alias("status"),
        )
    )


def scale_projection(stages: DataFrame) -> DataFrame:
    """(scale, chunks, amount, unit): time to embed more chunks at the measured speed; none without one."""
    scales = stages.sparkSession.createDataFrame(
        SCALES, "scale string, chunks long, unit string, seconds_per_unit double"
    )
    speed = stages.agg(_metric("embedding", "chunks_per_second")).scalar()
    measured = scales.withColumn("_speed", speed).where(F.col("_speed") > 0)
    amount = F.col("chunks") / F.col("_speed") / F.col("seconds_per_unit")
    return measured.select("scale", "chunks", F.round(amount, 1).alias("amount"), "unit")


def metrics_row(stages: DataFrame) -> DataFrame:
    """The exported row: 18 columns, defaults for whatever was not measured."""
    return stages.agg(
        *[
            F.coalesce(_metric(stage, metric), F.lit(default)).alias(column)
            for column, stage, metric, default in EXPORT_COLUMNS
        ]
    )


def latest_checkpoint(names: DataFrame, name: str = "name") -> DataFrame:
    """One row: the checkpoint with the highest number after its last underscore."""
    number = F.regexp_extract(name, r"_(\d+)$", 1).cast("long")
    return names.where(F.col(name).rlike(r"^checkpoint_\d+$")).agg(
        F.max_by(F.col(name), number).alias("latest"), F.max(number).alias("number")
    )
