"""Line de-duplication: lines that many documents share leave all but one of them.

Lines are exploded, normalised and hashed (128 bits); documents are counted per
hash with a partial aggregate before the shuffle, so one line in a third of all
rows costs one row per task. Only hashes, ids and positions travel; a document's
text moves at most once, to meet the positions it loses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, cut_lineage, exploded, id_key, lower_ascii, sized_broadcast


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per input row: ``(id, n_lines, n_dropped, kept)``.

    A key of ``min_chars`` code points or more that occurs in ``min_docs``
    distinct ids or more loses all its lines, except those in the largest id.
    Null and empty texts are one empty line. A null id counts as the smallest
    id, one for all rows without an id. Rows that repeat an id count once
    and each get a result. Other columns are ignored.
    """
    id_type = docs.schema[id_col].dataType
    base = docs.select(id_key(F.col(id_col)).alias("k"), F.col(id_col).cast(id_type).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("t", F.xxhash64("text"))
    split = base.select("k", "t", F.split("text", "\n", -1).alias("all"))
    lines = (exploded(split, "all", "line", "pos").where(F.char_length(F.btrim("line", F.lit(BLANKS))) >= min_chars)
             .select("k", "t", "pos", line_key(F.col("line")).alias("key"))
             .select("k", "t", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit("line"), "key").alias("h2")))
    common = cut_lineage(lines.groupBy("h1", "h2")
                         .agg(F.count_distinct("k").alias("n"), F.max("k").alias("keep"))
                         .where(F.col("n") >= min_docs).select("h1", "h2", "keep"))
    drops = (lines.join(sized_broadcast(common, 24), ["h1", "h2"]).where("k <> keep")
             .groupBy("k", "t").agg(F.array_sort(F.collect_set("pos")).alias("drop")))
    joined = base.join(drops, ["k", "t"], "left").withColumn("lines", F.split("text", "\n", -1))
    n = F.size("lines")
    # what stays are the stretches between dropped positions: linear in the lines
    starts = F.transform(F.concat(F.array(F.lit(-1)), "drop"), lambda p: p + 1)
    ends = F.concat("drop", F.array(n))
    kept = F.flatten(F.zip_with(starts, ends, lambda s, e: F.slice("lines", s + 1, e - s)))
    return joined.select(
        F.col("id").alias(id_col), n.cast("long").alias("n_lines"),
        F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept"))
