"""Corpus / chunk-store / index sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators._plan import _WRITTEN
from ..operators.corpus import ARTICLE_SCHEMA
from ..session import ensure_checkpoint_dir

#: Requests of a micro-batch, about, when a stored log is replayed as a stream.
SLICE_ROWS = 500_000

REQUEST_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def read_articles(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """A1: nested articles with an explicit schema (never inferred)."""
    return spark.read.schema(ARTICLE_SCHEMA).format(fmt).load(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """A2: overwrite the chunk store."""
    chunks.write.mode("overwrite").parquet(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """A3: read the chunk store; a missing or empty store is an error."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise ValueError(f"no chunk table at {path}") from e
    if df.isEmpty():
        raise ValueError(f"no chunk rows at {path}")
    return df


def read_index_optional(spark: SparkSession, path: str):
    """The stored vector index, or None when it is missing (callers then
    fall back to exact search)."""
    from ..operators.ann import MissingIndex, read_index
    try:
        return read_index(spark, path)
    except MissingIndex:
        return None


def request_stream(spark: SparkSession, directory: str, file_glob: str = "events.parquet",
                   schema: T.StructType = REQUEST_SCHEMA, max_files_per_trigger: int | None = None) -> DataFrame:
    """The request log as a stream (file source; Kafka in production)."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def request_slices(spark: SparkSession, directory: str, file: str = "events.parquet", schema: T.StructType = REQUEST_SCHEMA,
                   order: tuple[str, ...] = ("ts", "event_id"), rows: int = SLICE_ROWS) -> DataFrame:
    """A7 for a log of any size: the whole stored log as a stream whose micro-batches are consecutive stretches of its
    ``order``, of about ``rows`` requests each; a log of one such stretch is read as it is.

    A longer log is dealt by ranges of ``order`` into files below the checkpoint folder, written one after the other, since the file
    source takes files by the time they were written."""
    log = spark.read.schema(schema).parquet(f"{directory}/{file}")
    n = -(-log.count() // rows)
    if n <= 1:
        return request_stream(spark, directory, file, schema)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-streams/slices-{uuid.uuid4().hex}"
    _WRITTEN.append(base)
    dealt = log.repartitionByRange(n, *order).withColumn("_slice", F.spark_partition_id())
    dealt.write.partitionBy("_slice").parquet(f"{base}/dealt")
    for i in sorted(r[0] for r in spark.read.parquet(f"{base}/dealt").select("_slice").distinct().collect()):  # slice numbers
        spark.read.schema(schema).parquet(f"{base}/dealt/_slice={i}").coalesce(1).write.mode("append").parquet(f"{base}/log")
    return request_stream(spark, f"{base}/log", "*.parquet", schema, max_files_per_trigger=1)
