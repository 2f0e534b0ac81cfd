"""Benchmark decontamination by SimHash over item-sized windows.

1. Items and documents become hashes of five-word shingles (letters and digits,
   lower case). A window as long as an item, in words, is laid wherever a document shares
   a shingle with an item, aligned to it; a window without a shared shingle has similarity 0. An item of
   under five words is one shingle, and windows as short as it are hashed as it is.
2. Every window gets a 64-bit SimHash of its shingles.
3. Multi-index Hamming search: 64 bits in six blocks; within 17 bits some block differs
   in at most two (pigeonhole), so items are indexed under every value within two
   bits of each block and windows look up their six blocks. Nothing within the radius is missed.
4. Weighted Jaccard (multiset of shingles) of the pair verifies candidates.

Two texts of similarity 0.8 differ in about 10 of 64 bits, so 17 leaves some
two and a half standard deviations.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, exploded, id_key, sized_broadcast

WORDS = 5
SIMILARITY = 0.8
RADIUS = 17
#: Widths of the six blocks, low bits first.
BLOCKS = (11, 11, 11, 11, 10, 10)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def shingles(w: str, n: int = WORDS) -> Column:
    """Hashes of ``n``-word shingles of an array column, repeats included. Fewer words: the whole
    sequence is the one shingle; none: no shingle."""
    size = F.size(w)
    at = F.transform(F.col(w), lambda x, i: F.xxhash64(x, *[F.get(F.col(w), i + j) for j in range(1, n)]))
    return (F.when(size >= n, F.slice(at, 1, size - (n - 1)))
            .when(size > 0, F.array(F.xxhash64(F.lit("short"), F.array_join(w, " "))))
            .otherwise(F.array().cast("array<long>")))


def short_windows(w: str, n: int) -> Column:
    """Hashes of all ``n``-word windows of an array column, ``n`` under WORDS, as ``shingles`` hashes a text of just these words."""
    at = F.sequence(F.lit(1), F.size(w) - (n - 1))
    hashed = F.transform(at, lambda i: F.xxhash64(F.lit("short"), F.array_join(F.slice(F.col(w), i, n), " ")))
    return F.when(F.size(w) >= n, hashed).otherwise(F.array().cast("array<long>"))


def simhash(rows: DataFrame, keys: list[str], h: str = "h") -> DataFrame:
    """``(*keys, fp, weight)`` of shingle rows: a bit is 1 if it is in over half of the hashes.

    Bits j and j + 32 are counted together in the halves of one sum."""
    lanes = [F.sum(F.expr(f"shiftrightunsigned({h}, {j}) & 4294967297L")).alias(f"s{j}") for j in range(32)]
    sums = rows.groupBy(*keys).agg(F.count("*").alias("weight"), *lanes)
    # over half, for both halves of a lane: bit j and bit j + 32
    bits = [f"IF((s{j} & 4294967295L) * 2 > weight, {1 << j}L, 0L) | "
            f"IF(shiftrightunsigned(s{j}, 32) * 2 > weight, {_long(1 << (j + 32))}, 0L)" for j in range(32)]
    fp = F.aggregate(F.array(*[F.expr(b) for b in bits]), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return sums.select(*keys, fp.alias("fp"), "weight")


def _long(x: int) -> str:
    return f"{x}L" if x < 1 << 63 else "shiftleft(1L, 63)"


def _blocks(fp: Column) -> list[Column]:
    out, low = [], 0
    for width in BLOCKS:
        out.append(F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1)))
        low += width
    return out


def index_items(items: DataFrame, radius: int) -> DataFrame:
    """``(n, block, value, item, item_fp)``: each item under every block value within ``radius // 6`` bits."""
    near = radius // len(BLOCKS)

    def masks(width: int) -> list[int]:
        return [sum(1 << b for b in bits) for k in range(near + 1) for bits in combinations(range(width), k)]

    def keys(block: int, value: Column) -> Column:
        near_masks = F.array(*[F.lit(m).cast("long") for m in masks(BLOCKS[block])])
        return F.transform(near_masks, lambda m: F.struct(F.lit(block).alias("block"), value.bitwiseXOR(m).alias("value")))
    probes = F.concat(*[keys(i, v) for i, v in enumerate(_blocks(F.col("fp")))])
    return (items.select("n", "item", F.col("fp").alias("item_fp"), F.explode(probes).alias("p"))
            .select("n", "item", "item_fp", "p.block", "p.value"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text",
               similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``(id, item, start, n_words, distance, similarity)``: the best window for each document and item.

    ``start`` is the window's first word. An item of under five words is one shingle and matches where just these
    words stand, anywhere in a document. Null and empty texts match
    nothing. Items with a null id are one item per text; rows that repeat an id, null included, are one
    document per text. Ties go to the earliest window.
    """
    return (_leaks(docs, benchmark, id_col, text_col, item_col, item_text_col, similarity, radius)
            .select(F.col("b.id").alias(id_col), F.col("b.item").alias(item_col), (-F.col("b.s")).cast("long").alias("start"),
                    F.col("b.n").cast("long").alias("n_words"), F.col("b.distance").cast("long").alias("distance"), "b.similarity"))


def _leaks(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
           similarity: float, radius: int) -> DataFrame:
    """``(k, t, item_key, b)``: the best window ``b`` for each document, known by id and text hash, and item."""
    items = (benchmark.select(F.col(item_col).alias("item"), words(F.coalesce(F.col(item_text_col), F.lit(""))).alias("w"))
             .select("item", F.size("w").alias("n"), shingles("w").alias("sh")).distinct()
             .withColumn("item_key", F.xxhash64(F.col("item").cast("string"), "sh")))
    items = cut_lineage(items).where("n > 0")
    item_sh = items.select("item_key", F.explode("sh").alias("h"))
    item_fp = cut_lineage(items.select("item_key", "item", "n").join(simhash(item_sh, ["item_key"]), "item_key")
                          .withColumnRenamed("weight", "item_weight"))

    base = docs.select(id_key(F.col(id_col)).alias("k"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("t", _text_hash(F.col("text")))
    hashed = (base.select("k", "t", "id", words(F.col("text")).alias("w"))
              .select("k", "t", "id", F.size("w").alias("size"), shingles("w").alias("sh")))
    short = sorted(r["n"] for r in items.where(f"n < {WORDS}").select("n").distinct().collect())  # at most four numbers
    anchors = exploded(items.select("n", "sh"), "sh", "h", "off").distinct()
    met = (exploded(hashed.select("k", "t", "size", "sh"), "sh", "h", "pos")
           .join(sized_broadcast(anchors, 24), "h")
           .select("k", "t", "n", F.greatest(F.lit(0), F.least(F.col("pos") - F.col("off"), F.col("size") - F.col("n"))).alias("start"),
                   F.when(F.col("n") < WORDS, F.col("h")).alias("whole")))
    for n in short:
        w = base.select("k", "t", words(F.col("text")).alias("w")).select("k", "t", short_windows("w", n).alias("sh"))
        of_n = anchors.where(F.col("n") == n).select("h", "n")
        met = met.unionByName(exploded(w, "sh", "h", "start").join(sized_broadcast(of_n, 24), "h")
                              .select("k", "t", "n", "start", F.col("h").alias("whole")))
    # a window under five words is the one shingle it was met by; others are cut from the document's shingles
    starts = cut_lineage(met.groupBy("k", "t").agg(F.collect_set(F.struct("n", "start", "whole")).alias("wins")))
    windows = (base.join(sized_broadcast(starts, 200), ["k", "t"])
               .select("k", "t", "id", "wins", words(F.col("text")).alias("w"))
               .select("k", "t", "id", "wins", shingles("w").alias("sh"))
               .select("k", "t", "id", "sh", F.explode("wins").alias("x"))
               .select("k", "t", "id", "x.n", "x.start",
                       F.expr(f"if(x.whole is null, slice(sh, x.start + 1, x.n - {WORDS - 1}), array(x.whole))").alias("sh")))
    windows = windows.withColumn("win", F.xxhash64("k", "t", "n", "start", "sh"))
    windows = cut_lineage(windows.dropDuplicates(["win"]))
    win_sh = windows.select("win", F.explode("sh").alias("h"))
    win_fp = cut_lineage(windows.select("win", "k", "t", "id", "n", "start").join(simhash(win_sh, ["win"]), "win"))
    looked = win_fp.select("*", F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"), v.alias("value")) for i, v in enumerate(_blocks(F.col("fp")))])).alias("p"))
    looked = looked.select("win", "k", "t", "id", "n", "start", "fp", "weight", "p.block", "p.value")
    index = index_items(item_fp.select("n", "fp", F.col("item_key").alias("item")), radius)
    pairs = (looked.join(sized_broadcast(index, 40), ["n", "block", "value"])
             .withColumn("distance", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))))
             .where(F.col("distance") <= radius)
             .select("win", "k", "t", "id", "n", "start", "weight", F.col("item").alias("item_key"), "distance").distinct())
    pairs = cut_lineage(pairs)
    item_counts = item_sh.groupBy("item_key", "h").agg(F.count("*").alias("ic"))
    shared = (pairs.select("win", "item_key").join(win_sh.groupBy("win", "h").agg(F.count("*").alias("c")), "win")
              .join(sized_broadcast(item_counts, 24), ["item_key", "h"])
              .groupBy("win", "item_key").agg(F.sum(F.least("c", "ic")).alias("both")))
    close = (pairs.join(shared, ["win", "item_key"])
             .join(sized_broadcast(item_fp.select("item_key", F.col("item"), "item_weight"), 32), "item_key")
             .withColumn("similarity", F.col("both") / (F.col("weight") + F.col("item_weight") - F.col("both")))
             .where(F.col("similarity") >= similarity))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n", "distance", "item", "id"))
    return close.groupBy("k", "t", "item_key").agg(best.alias("b"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text",
                 similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``docs`` without the rows whose own text ``find_leaks`` names; all columns stay."""
    found = _leaks(docs, benchmark, id_col, text_col, item_col, item_text_col, similarity, radius)
    bad = cut_lineage(found.select(F.col("k").alias("_leak"), F.col("t").alias("_text")).distinct())
    return docs.join(sized_broadcast(bad, 24), (id_key(docs[id_col]) == bad["_leak"]) & (_text_hash(docs[text_col]) == bad["_text"]),
                     "left_anti")


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))
