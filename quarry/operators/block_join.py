"""Blocked similarity join: the primitive below vector search and similar pairs.

A query side of few blocks against a corpus without a key is scanned in place (``scan_topk``): query blocks of a
checked size are broadcast, and the corpus is not shuffled. All else is dealt into cells:

Two tables meet on an equality key (cache context, scope, inverted list). The rows of one key
are dealt by a hash of their id into chunks of bounded expected size, and each pair of a left and a
right chunk is one cell: a ``cogroup`` of two bounded tables, scored with one matrix product per slice.
Nothing passes through the driver but counts; a key that holds a third of all rows is many cells,
and rows with different keys never meet.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_limit
from ._plan import cut_lineage, sized_broadcast

#: Expected rows of a query chunk and of a corpus chunk in a top-k cell.
TOPK_BLOCKS = (2048, 16384)
#: Expected rows of a chunk in a cell of a threshold join.
PAIR_BLOCK = 8192
#: Right rows scored at a time within a cell, and scores of a top-k cell held at a time.
SLICE = 2048
SCORES = 1_000_000
#: Query blocks that a scan in place may hold; each task keeps the best of all their queries.
SCAN_BLOCKS = 16
#: Scores equal to so many decimals are ties, whatever order they were summed in.
DECIMALS = 9

KNN_SCHEMA = "query_id long, node_id long, score double"
PAIR_SCHEMA = "id_a long, id_b long, similarity double"


def equality_key(cols: Sequence[str] | None) -> Column:
    """The values of ``cols`` as one string that no other values share; nulls equal nulls."""
    if not cols:
        return F.lit("")
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(cols)]))


def matrix(col: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(col), dim)


def longs(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _chunks(df: DataFrame, out: str, block: int) -> DataFrame:
    return df.groupBy("_key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(out))


def cells(left: DataFrame, right: DataFrame, blocks: tuple[int, int],
          score: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``score`` of every pair of chunks with equal keys. Both sides: ``_key``, ``_id`` and payload."""
    chunks = _chunks(left, "_lc", blocks[0]).join(_chunks(right, "_rc", blocks[1]), "_key")
    chunks = sized_broadcast(chunks, 128)
    place = lambda n: F.pmod(F.xxhash64("_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = left.join(chunks, "_key").withColumn("_i", place("_lc")).withColumn("_j", every("_rc")).drop("_lc", "_rc")
    b = right.join(chunks, "_key").withColumn("_j", place("_rc")).withColumn("_i", every("_lc")).drop("_lc", "_rc")
    return a.groupBy("_key", "_i", "_j").cogroup(b.groupBy("_key", "_i", "_j")).applyInArrow(score, schema)


def top_positions(s: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best columns of each row: score descending, then id ascending."""
    n = s.shape[1]
    if n <= k:
        return np.lexsort((np.broadcast_to(ids, s.shape), -s), axis=-1)
    best = np.argpartition(-s, k - 1, axis=1)[:, :k]
    cut = np.take_along_axis(s, best, 1).min(axis=1)
    # where equal scores straddle the cut the ids decide
    for r in np.flatnonzero(((s >= cut[:, None]).sum(axis=1) > k) & np.isfinite(cut)):
        some = np.flatnonzero(s[r] >= cut[r])
        best[r] = some[np.lexsort((ids[some], -s[r, some]))[:k]]
    return best


def _fits(wanted: pa.ChunkedArray, have: pa.ChunkedArray) -> np.ndarray:
    """Left by right: the left value is null (no filter) or equal to the right one."""
    codes, _ = pd.factorize(pd.concat([wanted.to_pandas(), have.to_pandas()], ignore_index=True))
    q, c = codes[:len(wanted)], codes[len(wanted):]
    return (q[:, None] < 0) | (q[:, None] == c[None, :])


def knn(left: DataFrame, right: DataFrame, k: int, dim: int, *, exclude_self: bool = False, filters: int = 0,
        blocks: tuple[int, int] = TOPK_BLOCKS, scores: Callable | None = None) -> DataFrame:
    """Top ``k`` by inner product of each cell: at most ``k`` rows per query and cell.

    Sides hold ``_key, _id, _v`` and filter values ``_f0.. `` (a null on the left matches all). ``scores``
    replaces the product: ``(left vectors, right column) -> slice scorer``. Right rows become numbers a slice at a
    time, of some ``SCORES`` scores, so what a task holds does not grow with the cell."""
    def score(lt: pa.Table, rt: pa.Table) -> pa.Table:
        nq, nc = lt.num_rows, rt.num_rows
        if not nq or not nc:
            return _knn_table(*[np.empty(0)] * 3)
        qid, ids, qv = longs(lt, "_id"), longs(rt, "_id"), matrix(lt.column("_v"), dim)
        if scores is None:
            scorer = lambda a, b: qv @ matrix(rt.column("_v").slice(a, b - a), dim).T
        else:
            scorer = scores(qv, rt.column("_v"))
        best, at = np.full((nq, 0), -np.inf), np.zeros((nq, 0), np.int64)
        step = max(1, min(SLICE, SCORES // nq))
        for lo in range(0, nc, step):
            hi = min(nc, lo + step)
            s = scorer(lo, hi)
            ok = np.ones(s.shape, bool)
            if exclude_self:
                ok &= qid[:, None] != ids[None, lo:hi]
            for f in range(filters):
                ok &= _fits(lt.column(f"_f{f}"), rt.column(f"_f{f}").slice(lo, hi - lo))
            s = np.where(ok, s, -np.inf)
            pos = top_positions(np.round(s, DECIMALS), ids[lo:hi], k)
            best = np.concatenate((best, np.take_along_axis(s, pos, 1)), axis=1)
            at = np.concatenate((at, ids[lo:hi][pos]), axis=1)
            order = np.lexsort((at, -np.round(best, DECIMALS)), axis=-1)[:, :k]
            best, at = np.take_along_axis(best, order, 1), np.take_along_axis(at, order, 1)
        r, c = np.nonzero(np.isfinite(best))
        return _knn_table(qid[r], at[r, c], best[r, c])
    return cells(left, right, blocks, score, KNN_SCHEMA)


def _knn_table(q, n, s) -> pa.Table:
    return pa.table({"query_id": pa.array(q, pa.int64()), "node_id": pa.array(n, pa.int64()),
                     "score": pa.array(s, pa.float64())})


def packed(df: DataFrame, dim: int, rows: int, filters: int, prefix: str) -> DataFrame:
    """``(_id, _v, _f0 ..)`` as a row per ``rows`` rows of a partition: ids, vectors as float64 bytes, filter values."""
    names = [f"{prefix}ids", f"{prefix}v", *[f"{prefix}f{f}" for f in range(filters)]]
    schema = ", ".join([f"{names[0]} array<long>", f"{names[1]} binary", *[f"{c} array<string>" for c in names[2:]]])

    def pack(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = pa.Table.from_batches([batch.slice(lo, rows)])
                cols = [pa.array([longs(part, "_id")], pa.list_(pa.int64())),
                        pa.array([np.ascontiguousarray(matrix(part.column("_v"), dim)).tobytes()], pa.binary())]
                cols += [pa.array([part.column(f"_f{f}").to_pylist()], pa.list_(pa.string())) for f in range(filters)]
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return df.select("_id", "_v", *[f"_f{f}" for f in range(filters)]).mapInArrow(pack, schema)


def scan_topk(left: DataFrame, right: DataFrame, k: int, dim: int, *, exclude_self: bool = False, filters: int = 0,
              block: int = TOPK_BLOCKS[0], blocks: int = SCAN_BLOCKS) -> DataFrame | None:
    """As ``knn`` without a key, with the right side read where it lies; None if the left side is too large for that.

    The left side becomes at most ``blocks`` rows of ``block`` queries, whose bytes are checked against the broadcast limit;
    each task keeps the best ``k`` of every query over all slices that it reads."""
    n = left.count()
    if n > block * blocks or n * (8 * dim + 8 + 64 * filters) > broadcast_limit(left.sparkSession):
        return None
    few = left.coalesce(1) if n <= block else left.repartition(-(-n // block))
    asked = F.broadcast(cut_lineage(packed(few, dim, block, filters, "q")))

    def score(batches):
        best: dict[bytes, tuple] = {}
        for batch in batches:
            for row in batch.to_pylist():
                qid, ids = np.array(row["qids"], np.int64), np.array(row["cids"], np.int64)
                q, c = (np.frombuffer(row[x], np.float64).reshape(-1, dim) for x in ("qv", "cv"))
                s = q @ c.T
                ok = qid[:, None] != ids[None, :] if exclude_self else np.ones(s.shape, bool)
                for f in range(filters):
                    ok = ok & _fits(pa.chunked_array([pa.array(row[f"qf{f}"], pa.string())]), pa.chunked_array([pa.array(row[f"cf{f}"], pa.string())]))
                s = np.where(ok, s, -np.inf)
                pos = top_positions(np.round(s, DECIMALS), ids, k)
                key = qid.tobytes()
                _, top, at = best.get(key, (qid, np.empty((len(qid), 0)), np.empty((len(qid), 0), np.int64)))
                top = np.concatenate((top, np.take_along_axis(s, pos, 1)), axis=1)
                at = np.concatenate((at, ids[pos]), axis=1)
                order = np.lexsort((at, -np.round(top, DECIMALS)), axis=-1)[:, :k]
                best[key] = qid, np.take_along_axis(top, order, 1), np.take_along_axis(at, order, 1)
        for qid, top, at in best.values():
            r, c = np.nonzero(np.isfinite(top))
            yield from _knn_table(qid[r], at[r, c], top[r, c]).to_batches()
    met = packed(right, dim, SLICE, filters, "c").join(asked)  # a stated query set, in blocks
    return met.mapInArrow(score, KNN_SCHEMA)


def pairs(left: DataFrame, right: DataFrame, threshold: float, dim: int, block: int = PAIR_BLOCK) -> DataFrame:
    """Pairs of different ids whose inner product reaches ``threshold``, smaller id first.

    A pair that is found from both sides comes twice."""
    def score(lt: pa.Table, rt: pa.Table) -> pa.Table:
        return close_pairs(lt, rt, threshold, dim, np.not_equal)
    return cells(left, right, (block, block), score, PAIR_SCHEMA)


def self_pairs(df: DataFrame, threshold: float, dim: int, block: int = PAIR_BLOCK) -> DataFrame:
    """As ``pairs`` of a table with itself, each pair of rows once: chunks meet later chunks and themselves."""
    chunks = sized_broadcast(_chunks(df, "_n", block), 64)
    dealt = df.join(chunks, "_key").withColumn("_c", F.pmod(F.xxhash64("_id"), F.col("_n")).cast("int"))
    a = dealt.withColumnRenamed("_c", "_i").withColumn("_j", F.explode(F.sequence("_i", F.col("_n") - 1)))
    b = dealt.withColumnRenamed("_c", "_j").withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_j"))))
    b = b.toDF(*b.columns)  # columns of its own: both sides come from one table

    def score(key: tuple, lt: pa.Table, rt: pa.Table) -> pa.Table:
        same = key[1].as_py() == key[2].as_py()
        return close_pairs(lt, rt, threshold, dim, np.less if same else np.not_equal)
    return a.groupBy("_key", "_i", "_j").cogroup(b.groupBy("_key", "_i", "_j")).applyInArrow(score, PAIR_SCHEMA)


def close_pairs(lt: pa.Table, rt: pa.Table, threshold: float, dim: int, ids_fit: Callable) -> pa.Table:
    a, b, sim = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    if lt.num_rows and rt.num_rows:
        qid, ids = longs(lt, "_id"), longs(rt, "_id")
        q, c = matrix(lt.column("_v"), dim), matrix(rt.column("_v"), dim)
        for lo in range(0, len(ids), SLICE):
            s, some = q @ c[lo:lo + SLICE].T, ids[lo:lo + SLICE]
            r, w = np.nonzero((s >= threshold) & ids_fit(qid[:, None], some[None, :]))
            a.append(np.minimum(qid[r], some[w]))
            b.append(np.maximum(qid[r], some[w]))
            sim.append(s[r, w])
    return pa.table({"id_a": np.concatenate(a), "id_b": np.concatenate(b), "similarity": np.concatenate(sim)})
