"""Small planning helpers shared by the operators."""

from __future__ import annotations

import os
import uuid
import tempfile
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_limit, ensure_checkpoint_dir


def sized_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """Broadcast-hint ``df`` only when its counted size is under the limit.

    The count is the proof of the bound; above it the hint is left off and
    Spark plans a shuffle join (AQE may still switch on measured sizes).
    """
    n = df.count()
    if n * row_bytes <= broadcast_limit(df.sparkSession):
        return F.broadcast(df)
    return df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    (``spark.checkpoint.dir``) and continue from the table.

    Survives executor loss (unlike ``localCheckpoint``), is columnar and
    compressed (unlike an RDD checkpoint of serialised rows) and gives the
    optimizer real file statistics for the next stage.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/quarry-tables/{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: reading it back needs no footer inference
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []


def add_rows(df: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """The table of ``cut_lineage`` with the rows of ``df`` added to it (a new one without ``table``): one scan, however often."""
    spark = df.sparkSession
    path = getattr(table, "_quarry_path", None)
    if path is None:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-tables/{uuid.uuid4().hex}"
        _WRITTEN.append(path)
    df.write.mode("append").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quarry_path = path
    return out


def release_tables(spark: SparkSession) -> int:
    """Delete the intermediate tables this process wrote with ``cut_lineage``.

    Call it once the results that read them have been consumed (they are
    lazy). Uses the Hadoop file system of each path, so it works on the
    shared checkpoint storage of a cluster. Returns the number removed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _WRITTEN:
        p = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            n += 1
    return n


def gen_rows(arr, value: str, pos: str | None = None) -> list:
    """Columns exploding ``arr`` into rows without Catalyst's inferred
    ``size(arr) > 0`` filter, which would evaluate an expensive array
    expression (a UDF, a regex) a second time below the next exchange.
    Use with ``.where(F.col(pos or value + "_pos").isNotNull())``."""
    p = pos or value + "_pos"
    return [F.posexplode_outer(arr).alias(p, value)]


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable in local Python workers.

    On a cluster the package is deployed with ``--py-files`` or installed on
    the executors; in local mode it is zipped once per context and added.
    """
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED or not sc.master.startswith("local"):
        return
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    tmp = tempfile.mkdtemp(prefix="quarry-pkg-")
    path = os.path.join(tmp, "quarry.zip")
    with zipfile.ZipFile(path, "w") as z:
        for root, _, files in os.walk(pkg):
            if "__pycache__" in root:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(key)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a source with fewer partitions than the cluster has cores.

    A single-row-group file is read as one task; CPU-heavy text work after
    it (regex, shingles, MinHash, chunking) would then run on one core. On
    a real corpus (many files / row groups) this is a no-op.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def joined_terms(terms) -> Column:
    """A row's word terms as one string, which goes to Python faster than a list (see ``term_lists``)."""
    return F.array_join(terms, " ")


#: Rows, and bytes of terms, of a batch that ``term_lists`` gives.
LIST_ROWS = 2048
LIST_BYTES = 4_000_000


def term_lists(batches, name: str) -> Iterator:
    """Arrow batches with the ``joined_terms`` of column ``name`` as lists again (null: null, no term: empty), in stretches of
    bounded rows and bytes, so what is held besides a batch does not grow with it."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for rb in batches:
        at = rb.schema.get_field_index(name)
        ends = np.cumsum(pc.binary_length(rb.column(at)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < rb.num_rows:
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, min(lo + LIST_ROWS, int(np.searchsorted(ends, before + LIST_BYTES, side="right"))))
            part = rb.slice(lo, hi - lo)
            text = part.column(at)
            lists = pc.split_pattern(text, " ")
            if pc.any(pc.equal(text, "")).as_py():  # split, that is one empty term
                some = pc.fill_null(pc.not_equal(text, ""), True)
                lens = pc.if_else(some, pc.list_value_length(lists).fill_null(0), 0).to_numpy(zero_copy_only=False)
                flat = pc.list_flatten(pc.if_else(some, lists, pa.nulls(len(text), lists.type)))
                offs = pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offs, flat, mask=text.is_null())
            columns = list(part.columns)
            columns[at] = lists
            yield pa.RecordBatch.from_arrays(columns, names=rb.schema.names)
            lo = hi
