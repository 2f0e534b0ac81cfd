"""Sharding by weighted rendezvous hashing of stable record keys.

A record goes to the shard with the largest ``-weight / ln(u)``, where ``u`` in
(0, 1) is a hash of the record key and the shard number. Adding a shard only
takes records into the new one. No state, no shuffle for the shard itself; the
gapless slot is numbered in small hash ranges of a shard, so one shard is never
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, fresh, sized_broadcast


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard number 0..len(weights)-1 of a string key. Weights must be positive.

    A null key is the record named by the empty string with a marker of its own.
    """
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("rendezvous needs at least one shard and positive weights")
    name = F.coalesce(F.concat(F.lit("k"), key), F.lit("null"))

    def score(i: int, w: float) -> Column:
        # 52 bits of the hash, centred: strictly between 0 and 1
        u = (F.shiftrightunsigned(F.xxhash64(name, F.lit(i)), 12).cast("double") + 0.5) / F.lit(float(2**52))
        return F.lit(float(w)) / -F.log(u)
    best = F.greatest(*[F.struct(score(i, w).alias("s"), F.lit(-i).alias("i"))
                        for i, w in enumerate(weights)]) if len(weights) > 1 else None
    return F.lit(0) if best is None else -best["i"]


def assign_shards(docs: DataFrame, weights: Sequence[float], id_col: str = "doc_id",
                  shard_col: str = "shard") -> DataFrame:
    """``docs`` with a shard column (replaced if there). Keeps every row and column;
    rows that repeat an id share its shard, rows without an id share one."""
    return docs.withColumn(shard_col, rendezvous(F.col(id_col).cast("string"), weights).cast("int"))


def number_slots(rows: DataFrame, shard_col: str, order: Sequence[str], slot_col: str = "slot",
                 ranges: int = 64) -> DataFrame:
    """Gapless numbers from 0 within each shard, in the order of a hash of the ``order`` columns and the row's part of the table.

    Two levels: rows are counted per (shard, hash range), the counts are summed up
    over ranges (shards x ranges rows), and rows are numbered within a range. The hash covers all order columns and the
    part, so that neither null ids nor rows equal in everything, if they are many, lie in one range. The
    table is stored first, so that its parts stay; runs over equal files agree."""
    h, r, n, o = (fresh(rows, x) for x in "hrno")
    whole = [x for c in order for x in (F.col(c), F.col(c).isNull())]  # a hash alone skips nulls
    rows = rows.withColumn(h, F.xxhash64(*whole, F.spark_partition_id()))
    rows = cut_lineage(rows.withColumn(r, F.pmod(F.shiftrightunsigned(h, 20), F.lit(ranges))))
    counts = rows.groupBy(shard_col, r).agg(F.count("*").alias(n))
    before = Window.partitionBy(shard_col).orderBy(r).rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(counts.select(shard_col, r, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(o)))
    inside = Window.partitionBy(shard_col, r).orderBy(h, *order)
    return (rows.join(sized_broadcast(offsets, 32), [shard_col, r])
            .withColumn(slot_col, (F.row_number().over(inside) - 1 + F.col(o)).cast("long"))
            .drop(h, r, o))


def shard_report(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard, slot and the shard after growing by one, per row of ``docs``.

    A null text has size 8 and the checksum of the empty text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = assign_shards(rows, [1.0] * shards, "doc_id")
    rows = assign_shards(rows, [1.0] * (shards + 1), "doc_id", "grown_shard")
    rows = number_slots(rows, "shard", ["doc_id", "size", "text_crc32"], ranges=_ranges(rows, shards))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _ranges(rows: DataFrame, shards: int, rows_per_range: int = 100_000) -> int:
    """Hash ranges per shard, so that a numbering task gets a bounded stretch."""
    return max(16, -(-rows.count() // (shards * rows_per_range)))  # a count of rows, nothing is made for it
