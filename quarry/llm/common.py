"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators._plan import cut_lineage, sized_broadcast

__all__ = ["BLANKS", "NO_ID", "components", "cut_lineage", "exploded", "fresh", "id_key", "lower_ascii", "sized_broadcast", "table"]

# The blanks of the word and line rules, and the letters that
# are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Stands for a null id inside joins and orderings (below every real id).
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_key(col: Column) -> Column:
    return F.coalesce(col.cast("long"), F.lit(NO_ID))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` has not, whatever the case: ``_name``, with further underscores if need be."""
    taken = {c.lower() for c in df.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z, other letters untouched. Pure ASCII text takes the fast
    built-in ``lower``, which is the same thing there."""
    return (F.when(F.octet_length(col) == F.char_length(col), F.lower(col))
            .otherwise(F.translate(col, UPPER, UPPER.lower())))


def exploded(df: DataFrame, array: str, value: str, pos: str) -> DataFrame:
    """``df`` with the array as rows. The outer form keeps Catalyst from testing the array's size
    below the generator, where it would compute an array of a long expression twice."""
    others = [c for c in df.columns if c != array]
    return df.select(*others, F.posexplode_outer(array).alias(pos, value)).where(F.col(pos).isNotNull())


#: Edges (16 bytes each) up to which a round is one partition: shuffles of so little cost the driver a task and its metrics
#: a partition, and nothing is gained.
FEW_EDGES = 1 << 16


def components(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """Connected components of ``edges(u long, v long)`` by alternating large-star
    and small-star steps; returns ``(node, root)`` for every node that is not
    its own root (the root is the smallest node of the component).

    Each step is a grouped minimum (combined before the shuffle) and a join
    that adaptive execution may split; every round is written as a table in the
    checkpoint folder, so a lost executor costs one round. A table of up to ``few``
    edges, counted each round, is not dealt out. Self-loops and
    repeated edges are ignored; an empty table gives an empty table.
    """
    e = (edges.where("u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = cut_lineage(e)
    state = _state(e)
    while True:
        # the rows of one partition are together: no exchange
        near = (lambda df: df.coalesce(1)) if state[0] <= few else (lambda df: df)
        both = near(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))  # no more rows than edges; repeats go below
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = cut_lineage(near(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                             .unionByName(low.select("u", F.col("m").alias("v")))).distinct())
        new = _state(e)
        if new == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = new


def _state(e: DataFrame) -> tuple:
    """Count and order-free digest of an edge table."""
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                       F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
