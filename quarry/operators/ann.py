"""Inverted-file (IVF) lists and product quantisation (PQ).

Tables: ``centroids(list_id, centroid)`` and ``codebook(m, code, centroid)`` are broadcast after their size is
checked; centroids above the limit stay a table and are found through a second level of about the square
root as many centroids (``centroid_tree``). The entry
table ``(node_id, list_id, embedding, codes)`` is the big one; written with
``partitionBy("list_id")`` it lets a probe read only the probed lists.

Search turns each query into a row per probed list and joins these rows with the entries of the
list in cells of bounded size (``block_join``): exact inner products, or
sums from a table of code scores.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import l2_normalize
from ..session import broadcast_limit
from . import block_join
from ._plan import cut_lineage, sized_broadcast
from .vector_search import ranked, same_length, vector_dim

# Index parameters of the reference.
NLIST = 50
PQ_M = 32
PQ_NBITS = 1
NPROBE = 5

#: Super-lists that a vector looks into where centroids are a tree.
BRANCHES = 8
#: Probed lists that a scan names; more are a semi-join.
MAX_NAMED_LISTS = 4096
#: Queries whose table of code scores is held at a time.
CODE_QUERIES = 128
#: Vectors encoded at a time.
ENCODED = 1024


def _is_small(df: DataFrame, vec_col: str = "centroid") -> bool:
    floats = df.agg(F.sum(F.size(vec_col))).first()[0] or 0
    return floats * 8 <= broadcast_limit(df.sparkSession)


def _check_small(n_floats: int, spark, what: str) -> None:
    if n_floats * 8 > broadcast_limit(spark):
        raise ValueError(f"{what} too large to broadcast ({n_floats} floats)")


def _to_matrix(df: DataFrame, key_cols: list[str], vec_col: str, what: str) -> tuple[np.ndarray, np.ndarray]:
    """A small table on the driver; its size is counted before any row is."""
    floats = df.agg(F.sum(F.size(vec_col))).first()[0] or 0
    _check_small(floats, df.sparkSession, what)
    tbl = df.orderBy(*key_cols).toArrow()
    keys = np.stack([tbl.column(c).to_numpy() for c in key_cols], axis=1)
    d = len(tbl.column(vec_col)[0]) if tbl.num_rows else 0
    return keys, (block_join.matrix(tbl.column(vec_col), d) if tbl.num_rows else np.zeros((0, 0)))


# ---------------------------------------------------------------- C1 training
def label_centroids(v: DataFrame, *, label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """Supervised coarse lists: one centroid per label (normalised mean vector)."""
    per_dim = (v.select(F.col(label_col).alias("list_id"), F.posexplode(vec_col).alias("j", "x"))
               .groupBy("list_id", "j").agg(F.avg("x").alias("x")))
    c = per_dim.groupBy("list_id").agg(F.sort_array(F.collect_list(F.struct("j", "x"))).alias("s"))
    return c.select(F.col("list_id").cast("int").alias("list_id"),
                    l2_normalize(F.transform("s", lambda e: e["x"].cast("float")), strict=False).alias("centroid"))


def train_ivf(v: DataFrame, nlist: int | None = None, *, vec_col: str = "embedding",
              seed: int = 42, max_iter: int = 20) -> DataFrame:
    """Cosine k-means (Spark ML) on all vectors. ``nlist`` defaults to
    ``4 * sqrt(n)``. Returns ``list_id, centroid`` (unit vectors)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    if nlist is None:
        nlist = max(1, int(4 * math.sqrt(v.count())))
    # every iteration reads the vectors: normalised and written once
    data = cut_lineage(v.select(l2_normalize(vec_col, strict=False).alias("u")))
    data = data.select(array_to_vector("u").alias("features"))
    model = KMeans(k=nlist, distanceMeasure="cosine", seed=seed, maxIter=max_iter).fit(data)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    c = v.sparkSession.createDataFrame(rows, "list_id int, centroid array<double>")
    return c.select("list_id", l2_normalize(F.transform("centroid", lambda x: x.cast("float")), strict=False)
                    .alias("centroid"))


def label_split_codebook(v: DataFrame, m: int = PQ_M, *, label_col: str = "label",
                         vec_col: str = "embedding", split: int = 5) -> DataFrame:
    """A fixed 1-bit codebook from the data: in each sub-space, code 0 is the
    mean sub-vector of rows with label < split, code 1 of the others."""
    d = vector_dim(v, vec_col)
    if d % m:
        raise ValueError(f"product quantisation: {d} elements do not split into {m} equal parts")
    sub = d // m
    x = v.select((F.col(label_col) >= split).cast("int").alias("code"), F.posexplode(vec_col).alias("j", "x"))
    agg = (x.groupBy((F.col("j") / sub).cast("int").alias("m"), "code", (F.col("j") % sub).alias("i"))
           .agg(F.avg("x").alias("x")))
    return (agg.groupBy("m", "code").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("s"))
            .select("m", F.col("code").cast("int").alias("code"),
                    F.transform("s", lambda e: e["x"]).alias("centroid")))


def train_pq(v: DataFrame, m: int = PQ_M, nbits: int = PQ_NBITS, *, vec_col: str = "embedding",
             iters: int = 25, start: DataFrame | None = None) -> DataFrame:
    """K-means in each of ``m`` sub-spaces (at most 2^nbits centroids) over all vectors.

    Lloyd steps: a task adds up its vectors per sub-space and nearest code, Spark adds up the
    tasks, and the driver sees ``m * 2^nbits`` means. The start is the codebook ``start`` (``m, code, centroid``) or the
    distinct vectors of the least hashes, so runs agree; a code that loses all its vectors keeps its place. Stops early
    once no mean moves."""
    d = vector_dim(v, vec_col)
    if d % m:
        raise ValueError(f"product quantisation: {d} elements do not split into {m} equal parts")
    sub, kc = d // m, 1 << nbits
    data = cut_lineage(same_length(v, vec_col, d).select(F.col(vec_col).cast("array<double>").alias("x")))
    _check_small(m * kc * sub, v.sparkSession, "codebook")
    if start is not None:
        book = _codebook_tensor(start)
    else:
        first = data.select(F.xxhash64("x").alias("h"), "x").distinct().orderBy("h", "x").limit(kc).collect()
        book = np.array([r["x"] for r in first], np.float64).reshape(len(first), m, sub).transpose(1, 0, 2)
    k = book.shape[1]
    for _ in range(iters):
        bc = v.sparkSession.sparkContext.broadcast(book)

        def add_up(batches, bc=bc):
            cb = bc.value
            sums, counts = np.zeros((m * k, sub)), np.zeros(m * k, np.int64)
            for rb in batches:
                x = block_join.matrix(rb.column("x"), d).reshape(-1, m, sub)
                for j in range(m):
                    code, at = _nearest(x[:, j], cb[j]), slice(j * k, (j + 1) * k)
                    counts[at] += np.bincount(code, minlength=k)
                    for i in range(sub):
                        sums[at, i] += np.bincount(code, weights=x[:, j, i], minlength=k)
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({
                "at": pa.array(some, pa.int64()), "n": pa.array(counts[some], pa.int64()),
                "s": pa.array(list(sums[some]), pa.list_(pa.float64()))})
        parts = data.mapInArrow(add_up, "at long, n long, s array<double>")
        # at most m * 2^nbits rows
        means = parts.groupBy("at").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(sub)]).alias("s")).collect()
        bc.unpersist()
        new = book.reshape(m * k, sub).copy()
        for r in means:
            new[r["at"]] = np.array(r["s"]) / r["n"]
        new = new.reshape(m, k, sub)
        moved, book = not np.allclose(new, book, rtol=0, atol=1e-12), new
        if not moved:
            break
    rows = [(j, c, [float(x) for x in book[j, c]]) for j in range(m) for c in range(k)]
    return v.sparkSession.createDataFrame(rows, "m int, code int, centroid array<double>")


def _nearest(x: np.ndarray, centroids: np.ndarray, rows: int = 4096) -> np.ndarray:
    """Code of the nearest centroid (L2, the first of equals) of each row."""
    return np.concatenate([((x[i:i + rows, None, :] - centroids[None]) ** 2).sum(-1).argmin(1)
                           for i in range(0, len(x), rows)] or [np.empty(0, np.int64)])


# ---------------------------------------------------------------- C2 assign
def _centroid_matrix(centroids: DataFrame):
    keys, C = _to_matrix(centroids, ["list_id"], "centroid", "centroid table")
    return keys[:, 0].astype(np.int64), C


def _codebook_tensor(codebook: DataFrame):
    keys, C = _to_matrix(codebook, ["m", "code"], "centroid", "codebook")
    M, K = int(keys[:, 0].max()) + 1, int(keys[:, 1].max()) + 1
    return C.reshape(M, K, C.shape[1])


def assign_lists(v: DataFrame, centroids: DataFrame, *, vec_col: str = "embedding") -> DataFrame:
    """Adds ``list_id`` (best inner product, lowest id on ties) and ``list_score``.

    Centroids above the broadcast limit are searched through their tree: the best list of the nearest ``BRANCHES`` super-lists."""
    spark = v.sparkSession
    if not _is_small(centroids):
        uid = "_uid"
        while uid in v.columns:
            uid = f"_{uid}"
        rows = cut_lineage(v.withColumn(uid, F.monotonically_increasing_id()))
        best = nearest_lists(rows.select(F.col(uid).alias("_id"), F.col(vec_col).alias("_v")), centroids, 1)
        best = best.select(F.col("query_id").alias(uid), F.col("node_id").cast("int").alias("list_id"), F.col("score").alias("list_score"))
        return rows.join(best, uid).select(*v.columns, "list_id", "list_score")
    ids, C = _centroid_matrix(centroids)
    d = C.shape[1]
    bc = spark.sparkContext.broadcast((ids, C))
    schema = T.StructType(list(v.schema.fields)).add("list_id", T.IntegerType()).add("list_score", T.DoubleType())

    def run(batches):
        lid, Cm = bc.value
        for rb in batches:
            if rb.num_rows == 0:
                continue
            S = block_join.matrix(rb.column(vec_col), d) @ Cm.T
            best = S.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                list(rb.columns) + [pa.array(lid[best].astype(np.int32)),
                                    pa.array(S[np.arange(len(best)), best])],
                names=list(rb.schema.names) + ["list_id", "list_score"])
    return same_length(v, vec_col, d).mapInArrow(run, schema)


def centroid_tree(centroids: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Two levels over many centroids: ``(supers(list_id, centroid), leaves(list_id, centroid, super))``, about the square
    root as many super-lists as lists, trained on the centroids themselves."""
    n = centroids.count()
    supers = cut_lineage(train_ivf(centroids, max(1, math.ceil(math.sqrt(n))), vec_col="centroid", seed=seed))
    named = centroids.select(F.col("list_id").alias("leaf"), "centroid")
    leaves = assign_lists(named, supers, vec_col="centroid")
    return supers, cut_lineage(leaves.select(F.col("leaf").alias("list_id"), "centroid", F.col("list_id").alias("super")))


def nearest_lists(v: DataFrame, centroids: DataFrame, k: int, branches: int = BRANCHES,
                  tree: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """The ``k`` nearest lists of each ``(_id, _v)`` as ``query_id, node_id, score, rank``: vectors meet the centroids of their
    nearest ``branches`` super-lists in cells (``block_join``), so no centroid below the supers is collected or
    broadcast. With all branches it is the flat search."""
    supers, leaves = tree or centroid_tree(centroids)
    probes = probe_lists(v, supers, min(branches, supers.count())).drop("_list")
    right = leaves.select(F.col("super").cast("string").alias("_key"), F.col("list_id").cast("long").alias("_id"),
                          F.col("centroid").alias("_v"))
    return ranked(block_join.knn(cut_lineage(probes), right, k, vector_dim(centroids, "centroid")), k)


# ---------------------------------------------------------------- C3 encode
def pq_encode(v: DataFrame, codebook: DataFrame, *, vec_col: str = "embedding") -> DataFrame:
    """Adds ``codes array<tinyint>``: nearest (L2) code per sub-space."""
    spark = v.sparkSession
    CB = _codebook_tensor(codebook)
    M, K, sub = CB.shape
    bc = spark.sparkContext.broadcast(CB)
    schema = T.StructType(list(v.schema.fields)).add("codes", T.ArrayType(T.ByteType()))

    def run(batches):
        cb = bc.value
        for rb in batches:
            if rb.num_rows == 0:
                continue
            X = block_join.matrix(rb.column(vec_col), M * sub).reshape(rb.num_rows, M, sub)
            codes = np.concatenate([((X[i:i + ENCODED, :, None, :] - cb[None]) ** 2).sum(-1).argmin(-1).astype(np.int8)
                                    for i in range(0, len(X), ENCODED)])
            arr = pa.ListArray.from_arrays(pa.array(np.arange(0, (rb.num_rows + 1) * M, M, dtype=np.int32)),
                                           pa.array(codes.ravel(), pa.int8()))
            yield pa.RecordBatch.from_arrays(list(rb.columns) + [arr], names=list(rb.schema.names) + ["codes"])
    return same_length(v, vec_col, M * sub).mapInArrow(run, schema)


# ---------------------------------------------------------------- index
@dataclass
class IvfIndex:
    centroids: DataFrame
    entries: DataFrame          # node_id, list_id, embedding, [codes]
    codebook: DataFrame | None = None


def build_index(v: DataFrame, centroids: DataFrame, codebook: DataFrame | None = None, *,
                with_pq: bool = True, id_col: str = "node_id", vec_col: str = "embedding") -> IvfIndex:
    """C2 + C3: normalise (lenient), assign lists, optionally PQ-encode. The tables are written once, as every
    search reads them more than once."""
    centroids = cut_lineage(centroids)
    e = v.select(F.col(id_col).alias("node_id"), l2_normalize(vec_col, strict=False).alias("embedding"))
    e = assign_lists(e, centroids).drop("list_score")
    if with_pq and codebook is not None:
        codebook = cut_lineage(codebook)
        e = pq_encode(e, codebook)
    return IvfIndex(centroids, cut_lineage(e), codebook if with_pq else None)


# ---------------------------------------------------------------- C4 / C5 search
def probe_lists(v: DataFrame, centroids: DataFrame, nprobe: int) -> DataFrame:
    """``(_id, _v)`` to a row ``(_list, _key, _id, _v)`` for each of the ``nprobe`` lists nearest to the vector."""
    if not _is_small(centroids):
        near = nearest_lists(v, centroids, nprobe).select(F.col("query_id").alias("_id"), F.col("node_id").cast("int").alias("_list"))
        return v.join(near, "_id").select("_list", F.col("_list").cast("string").alias("_key"), "_id", "_v")
    lid, C = _centroid_matrix(centroids)
    if nprobe > len(lid):
        raise ValueError(f"nprobe is {nprobe}, but the index has {len(lid)} lists")
    bc, d = v.sparkSession.sparkContext.broadcast((lid, C)), C.shape[1]

    @F.pandas_udf("array<long>")
    def nearest(vectors: pd.Series) -> pd.Series:
        ids, c = bc.value
        s = np.stack(vectors.to_numpy()).astype(np.float64) @ c.T if len(vectors) else np.empty((0, len(ids)))
        return pd.Series(list(ids[np.argsort(-s, axis=1, kind="stable")[:, :nprobe]]))
    return (same_length(v, "_v", d).withColumn("_lists", nearest("_v"))
            .select("_id", "_v", F.posexplode_outer("_lists").alias("_at", "_list"))
            .select(F.col("_list").cast("int").alias("_list"), F.col("_list").cast("string").alias("_key"), "_id", "_v"))


def probed_entries(entries: DataFrame, probes: DataFrame, most: int = MAX_NAMED_LISTS) -> DataFrame:
    """The entries of the lists that some query probes. A stored index is partitioned by ``list_id``, so up to ``most``
    lists are named in the scan and the folders of all others are not read; more are a semi-join on the partition column."""
    lists = probes.select("_list").distinct()
    named = [r[0] for r in lists.limit(most + 1).collect()]  # list numbers, at most ``most`` and one
    if len(named) <= most:
        return entries.where(F.col("list_id").isin(sorted(named)))
    return entries.join(lists.select(F.col("_list").alias("list_id")), "list_id", "left_semi")


def _code_scores(bc) -> Callable:
    """Scores of coded vectors: a table of products of query parts and codes, a stretch of queries at a time."""
    def scores(qv: np.ndarray, codes: pa.ChunkedArray) -> Callable:
        cb = bc.value
        m, _, sub = cb.shape
        parts = qv.reshape(len(qv), m, sub)

        def scorer(lo: int, hi: int) -> np.ndarray:
            coded = block_join.matrix(codes.slice(lo, hi - lo), m).astype(np.int64)
            out = np.zeros((len(qv), hi - lo))
            for at in range(0, len(qv), CODE_QUERIES):
                lut = np.einsum("qms,mks->qmk", parts[at:at + CODE_QUERIES], cb)
                for j in range(m):
                    out[at:at + CODE_QUERIES] += lut[:, j, :][:, coded[:, j]]
            return out
        return scorer
    return scores


def ivf_topk(queries: DataFrame, index: IvfIndex, k: int = 50, *, nprobe: int = NPROBE,
             query_id: str = "query_id", vec_col: str = "embedding", exclude_self: bool = False,
             rescore: bool = True, blocks: tuple[int, int] = block_join.TOPK_BLOCKS) -> DataFrame:
    """C4 (exact scores inside the probed lists) or C5 (``rescore=False``:
    PQ lookup-table scores). Returns ``query_id, node_id, score, rank``.

    Each query becomes a row per probed list and meets the entries of that list in a blocked join, so a
    list is read once for all queries that probe it and a long list is split. Only centroids and
    codebook (checked sizes) are broadcast."""
    if not rescore and index.codebook is None:
        raise ValueError("PQ scores need an index built with a codebook")
    q = queries.select(F.col(query_id).cast("long").alias("_id"), F.col(vec_col).alias("_v"))
    q = cut_lineage(probe_lists(q, index.centroids, nprobe))
    stored = probed_entries(index.entries, q).select(
        F.col("list_id").cast("string").alias("_key"), F.col("node_id").cast("long").alias("_id"),
        F.col("embedding" if rescore else "codes").alias("_v"))
    scores = None
    if not rescore:
        scores = _code_scores(queries.sparkSession.sparkContext.broadcast(_codebook_tensor(index.codebook)))
    d = vector_dim(index.centroids, "centroid")
    return ranked(block_join.knn(q.drop("_list"), stored, k, d, exclude_self=exclude_self, blocks=blocks, scores=scores), k)


def ivf_pairs(index: IvfIndex, threshold: float, *, nprobe: int = NPROBE,
              block: int = block_join.PAIR_BLOCK) -> DataFrame:
    """C8 blocked by the IVF lists: every pair ``(a < b)`` of indexed vectors
    with inner product >= threshold such that one of them probes the other's
    list. Each vector meets only the lists it probes, so compute
    is about ``n^2 * nprobe / nlist`` instead of ``n^2``; with ``nprobe`` equal
    to the number of lists the result is the exact self-join.
    Returns ``id_a, id_b, similarity``."""
    own = index.entries.select(F.col("list_id").cast("string").alias("_key"),
                               F.col("node_id").cast("long").alias("_id"), F.col("embedding").alias("_v"))
    probes = cut_lineage(probe_lists(own.select("_id", "_v"), index.centroids, nprobe))
    found = block_join.pairs(probes.drop("_list"), own, threshold, vector_dim(index.centroids, "centroid"), block)
    # a pair can be found from both ends: keep one row per pair
    return found.groupBy("id_a", "id_b").agg(F.max("similarity").alias("similarity"))


# ---------------------------------------------------------------- A4 / A5 storage
def write_index(index: IvfIndex, path: str) -> None:
    """A4: a new version folder with entries partitioned by list and the small tables beside them, and
    last the manifest that names it. A write that fails midway leaves the manifest and the version that it
    names as they were; version folders no manifest names can be removed."""
    version = f"version-{uuid.uuid4().hex}"
    index.entries.write.partitionBy("list_id").parquet(f"{path}/{version}/entries")
    index.centroids.write.parquet(f"{path}/{version}/centroids")
    if index.codebook is not None:
        index.codebook.write.parquet(f"{path}/{version}/codebook")
    _write_manifest(index.entries.sparkSession, path, index.codebook is not None, version, [])


def _write_manifest(spark, path: str, has_pq: bool, version: str, deltas: list[str]) -> None:
    spark.createDataFrame([("ivf", has_pq, version, deltas)],
                          "index_type string, has_pq boolean, version string, deltas array<string>") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")


def add_to_index(spark, path: str, v: DataFrame, *, id_col: str = "node_id", vec_col: str = "embedding") -> None:
    """Adds vectors with their ids to a stored index; an id that is there already is replaced.

    The vectors are assigned to the stored lists (and encoded with the stored codebook) and written as a delta folder
    that the manifest then lists; nothing stored is rewritten. Ids within one call must be distinct. One writer at a time."""
    record = read_manifest(spark, path)
    stored = read_index(spark, path)
    new = build_index(v, stored.centroids, stored.codebook, id_col=id_col, vec_col=vec_col).entries
    _write_delta(spark, path, record, new.select("node_id"), new)


def delete_from_index(spark, path: str, ids: DataFrame, *, id_col: str = "node_id") -> None:
    """Takes ids out of a stored index, by a delta that holds nothing else. Ids that are not there do no harm."""
    _write_delta(spark, path, read_manifest(spark, path), ids.select(F.col(id_col).cast("long").alias("node_id")).distinct(), None)


def _write_delta(spark, path: str, record, ids: DataFrame, entries: DataFrame | None) -> None:
    delta = f"delta-{uuid.uuid4().hex}"
    if entries is not None:
        entries.write.partitionBy("list_id").parquet(f"{path}/{delta}/entries")
    ids.write.parquet(f"{path}/{delta}/ids")
    kind = "+" if entries is not None else "-"
    _write_manifest(spark, path, record["has_pq"], record["version"], [*record["deltas"], kind + delta])


def compact_index(spark, path: str) -> None:
    """Rewrites a stored index with its deltas as one new version."""
    write_index(read_index(spark, path), path)


class MissingIndex(ValueError):
    """There is no index at the path."""


def read_manifest(spark, path: str):
    """The one record of the manifest below ``path``, else an error."""
    try:
        man = spark.read.parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise MissingIndex(f"no index at {path}") from e
    n = man.count()
    if n == 0:
        raise MissingIndex(f"no index at {path}: its manifest is empty")
    if n > 1:
        raise ValueError(f"the manifest at {path} has {n} records where one is due")
    return man.first()


def read_index(spark, path: str) -> IvfIndex:
    """A5: exactly one manifest record, else an error. Entries that a later delta replaces or deletes are left
    out at read time, by an anti-join with the ids of the deltas."""
    record = read_manifest(spark, path)
    base = f"{path}/{record['version']}"
    entries = spark.read.parquet(f"{base}/entries")
    schema, deltas = entries.schema, record["deltas"]
    if deltas:
        names = [d[1:] for d in deltas]
        ids = None
        for i, d in enumerate(names):
            one = spark.read.parquet(f"{path}/{d}/ids").select("node_id", F.lit(i).alias("_by"))
            ids = one if ids is None else ids.unionByName(one)
        last = sized_broadcast(cut_lineage(ids.groupBy("node_id").agg(F.max("_by").alias("_last"))), 24)

        def live(rows: DataFrame, at: int) -> DataFrame:
            return rows.join(last.where(F.col("_last") > at).select("node_id"), "node_id", "left_anti")
        entries = live(entries, -1)
        for i, d in enumerate(deltas):
            if d[0] == "+":
                # an empty delta has no files: the schema is known
                entries = entries.unionByName(live(spark.read.schema(schema).parquet(f"{path}/{d[1:]}/entries"), i))
    return IvfIndex(spark.read.parquet(f"{base}/centroids"), entries,
                    spark.read.parquet(f"{base}/codebook") if record["has_pq"] else None)
