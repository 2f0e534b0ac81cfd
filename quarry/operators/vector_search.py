"""Exact vector search (C6, C7) and the exact similarity self-join.

Both are blocked similarity joins (``block_join``). A query side of few blocks, checked in size, is broadcast and
the corpus scanned where it lies; larger ones, and searches by context, meet
in cells of bounded size. A search keeps the best ``k`` of each task or cell, and a ``row_number()``
window (partial and final ``WindowGroupLimit``) merges them; the self-join emits the pairs that reach the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import block_join
from ._plan import cut_lineage


def same_length(df: DataFrame, vec_col: str, dim: int) -> DataFrame:
    """``df``, failing the task on a vector that is null or not ``dim`` long: no row is left out unseen."""
    v = F.col(vec_col)
    what = F.concat(F.lit(f"{vec_col}: a vector of length "), F.coalesce(F.size(v).cast("string"), F.lit("null")),
                    F.lit(f" where {dim} is due"))
    kind = df.schema[vec_col].dataType
    return df.withColumn(vec_col, F.when(v.isNotNull() & (F.size(v) == dim), v).otherwise(F.raise_error(what).cast(kind)))


def vector_dim(df: DataFrame, vec_col: str = "embedding") -> int:
    """Dimension of the vectors (from the first non-null row)."""
    row = df.select(F.size(vec_col).alias("d")).where(F.col(vec_col).isNotNull()).first()
    if row is None:
        raise ValueError("No vectors found.")
    return int(row["d"])


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """The best ``k`` hits of each query with their ``rank`` from 1; equal scores by node id."""
    w = Window.partitionBy("query_id").orderBy(F.round("score", block_join.DECIMALS).desc(), "node_id")
    return (hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .withColumn("rank", F.col("rank").cast("long")))


def vector_topk(queries: DataFrame, corpus: DataFrame, k: int = 50, *,
                query_id: str = "query_id", query_vec: str = "embedding",
                node_id: str = "node_id", node_vec: str = "embedding",
                group_cols: list[str] | None = None, exclude_self: bool = False,
                dim: int | None = None, filters: dict[str, str] | None = None,
                blocks: tuple[int, int] = block_join.TOPK_BLOCKS) -> DataFrame:
    """C6 (and C7 with ``group_cols``): exact inner-product top-k per query.

    Returns ``query_id, node_id, score, rank`` (rank from 1, ties by node_id).
    With ``group_cols`` a query only meets corpus rows with equal group values
    (the semantic-cache context: filters hash, version, tenant; a null equals a null). ``filters``
    maps corpus metadata columns to query filter columns (pre-filtering: a
    null filter matches everything, null metadata fails a non-null filter).
    ``blocks``: expected rows of a query chunk and a corpus chunk.
    """
    if dim is None:
        dim = vector_dim(corpus, node_vec)
    key = block_join.equality_key(group_cols)

    def side(df: DataFrame, id_col: str, vec: str, names: list[str]) -> DataFrame:
        values = [F.col(c).cast("string").alias(f"_f{i}") for i, c in enumerate(names)]
        return same_length(df, vec, dim).select(
            key.alias("_key"), F.col(id_col).cast("long").alias("_id"), F.col(vec).alias("_v"), *values)
    # the query side is read more than once (its size, then the join): made once
    q = cut_lineage(side(queries, query_id, query_vec, list((filters or {}).values())))
    c = side(corpus, node_id, node_vec, list((filters or {}).keys()))
    hits = None
    if not group_cols:
        hits = block_join.scan_topk(q, c, k, dim, exclude_self=exclude_self, filters=len(filters or {}), block=blocks[0])
    if hits is None:
        hits = block_join.knn(q, c, k, dim, exclude_self=exclude_self, filters=len(filters or {}), blocks=blocks)
    return ranked(hits, k)


def similar_pairs(df: DataFrame, threshold: float, *, id_col: str = "node_id",
                  vec_col: str = "embedding", dim: int | None = None,
                  scope: list[str] | None = None, block: int = block_join.PAIR_BLOCK) -> DataFrame:
    """Every pair ``(a < b)`` with inner product >= threshold, exactly.

    Chunks of at most ``block`` expected rows meet once; a task emits only the pairs that pass the threshold.
    With ``scope`` columns, pairs are only formed within equal scope values.
    """
    if dim is None:
        dim = vector_dim(df, vec_col)
    base = same_length(df, vec_col, dim).select(
        block_join.equality_key(scope).alias("_key"), F.col(id_col).cast("long").alias("_id"), F.col(vec_col).alias("_v"))
    return block_join.self_pairs(base, threshold, dim, block)
