"""Chat formatting with cumulative-snapshot collapse.

Logging systems store a conversation again after every turn. A snapshot whose
turns are a prefix of a longer conversation is dropped, equal ones keep the
smallest id, and what remains is rendered with a chat template.

The rolling prefix hash of a turn is the running xor, over the turns so far, of
two 64-bit hashes of (position, role, text). It is summed up over stretches of
turns first, cut by rank, so that one very long conversation is not one task, whatever its turn numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID, cut_lineage

#: Turns per row of rendered output.
STRETCH = 256


def numbered_turns(conv: DataFrame) -> DataFrame:
    """``(c, conv_id, i, role, text, h1, h2)``: turns numbered from 0 with the hash of their prefix.

    Order: turn (nulls first), role, text. Repeated rows count once. A null
    role or text is not the same as an empty one. Null ids are one conversation.
    """
    rows = conv.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("c"),
                       F.col("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").distinct()
    # stretches: parts of the table in order, so that turns without a number, or with one and the same, are cut as well
    rows = rows.repartitionByRange(int(conv.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                                   "c", F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    rows = cut_lineage(rows.withColumn("s", F.spark_partition_id()))
    inside = Window.partitionBy("c", "s").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    rows = rows.withColumn("i", F.row_number().over(inside).cast("long") - 1)
    before = Window.partitionBy("c").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("c", "s").agg(F.count("*").alias("n"))
    offset = sizes.select("c", "s", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("o"))
    rows = rows.join(offset, ["c", "s"]).withColumn("i", F.col("i") + F.col("o")).drop("o")
    part = [F.col("i"), F.coalesce(F.concat(F.lit("r"), "role"), F.lit("-")),
            F.coalesce(F.concat(F.lit("t"), "text"), F.lit("-"))]
    rows = rows.withColumn("x1", F.xxhash64(*part)).withColumn("x2", F.xxhash64(F.lit("chat"), *part))
    own = rows.groupBy("c", "s").agg(F.bit_xor("x1").alias("y1"), F.bit_xor("x2").alias("y2"))
    carry = own.select("c", "s", *[F.coalesce(F.bit_xor(y).over(before), F.lit(0)).alias(p)
                                   for y, p in (("y1", "p1"), ("y2", "p2"))])
    running = (Window.partitionBy("c", "s").orderBy("i")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.withColumn("r1", F.bit_xor("x1").over(running)).withColumn("r2", F.bit_xor("x2").over(running))
            .join(carry, ["c", "s"])
            .select("c", "conv_id", "i", "role", "text",
                    F.col("r1").bitwiseXOR(F.col("p1")).alias("h1"), F.col("r2").bitwiseXOR(F.col("p2")).alias("h2")))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """``(c, n_turns)`` of conversations that are no prefix of a longer one; of equal ones the smallest id."""
    sizes = turns.groupBy("c").agg(F.max("i").alias("i"))
    ends = turns.select("c", "i", "h1", "h2").join(sizes, ["c", "i"])
    one = ends.groupBy("i", "h1", "h2").agg(F.min("c").alias("c"))
    inner = (turns.select("c", "i", "h1", "h2").join(sizes.withColumnRenamed("i", "last"), "c")
             .where("i < last").select("i", "h1", "h2").distinct())
    return one.join(inner, ["i", "h1", "h2"], "left_anti").select("c", (F.col("i") + 1).alias("n_turns"))


def collapse_and_render(conv: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """``(conv_id, part, n_turns, first_turn, rendered)``: kept conversations as chat text.

    ``<|role|>`` line, text, ``<|end|>`` line per turn; null roles are ``unknown``, null texts empty. A
    conversation of more than ``stretch`` turns comes in numbered parts, so
    no row gathers an unbounded group.
    """
    turns = cut_lineage(numbered_turns(conv))
    kept = maximal_conversations(turns)
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"),
                    F.coalesce("text", F.lit("")), F.lit("\n<|end|>\n"))
    parts = (turns.join(kept, "c")
             .withColumn("part", F.floor(F.col("i") / stretch))
             .groupBy("c", "part")
             .agg(F.first("conv_id").alias("conv_id"), F.first("n_turns").alias("n_turns"),
                  F.min("i").alias("first_turn"),
                  F.array_sort(F.collect_list(F.struct("i", line.alias("line")))).alias("lines")))
    return parts.select("conv_id", "part", "n_turns", "first_turn",
                        F.array_join(F.col("lines.line"), "").alias("rendered"))
