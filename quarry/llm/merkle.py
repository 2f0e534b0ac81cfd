"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences.

* sentence: a paragraph cut after ``.``, ``!`` or ``?`` followed by one blank;
* paragraph: a line of the text; its node is the digest of its sentence digests;
* section: a run of paragraphs that ends after one whose digest begins with 0 or 1
  (about one in eight), so an inserted paragraph moves no other border;
* root: SHA-256 of the section digests, the fingerprint of the text.

Equal roots mean equal texts. Likeness compares the two node sets (root, sections,
paragraphs, sentences): shared nodes divided by all nodes, 1 only for equal roots.
Inner digests are the first 32 hex digits of SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID, cut_lineage, fresh, id_key, sized_broadcast


def _digest(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 32)


def with_tree(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Adds ``<prefix>root`` (64 hex digits) and ``<prefix>sections``, ``paragraphs``, ``sentences``
    (arrays of digests in text order; the sentences flat). The text column must not be null."""
    s, p, e = f"{prefix}sentences", f"{prefix}paragraphs", f"{prefix}sections"
    by_line = F.transform(F.split(text, "\n", -1),
                          lambda q: F.transform(F.split(q, r"(?<=[.!?]) ", -1), _digest))
    df = df.withColumn(s, by_line)
    df = df.withColumn(p, F.transform(s, lambda a: _digest(F.array_join(a, ""))))
    df = df.withColumn(s, F.flatten(s))
    marked = F.transform(p, lambda d: F.when(F.substring(d, 1, 1).isin("0", "1"), F.concat(d, F.lit("/"))).otherwise(d))
    runs = F.filter(F.split(F.array_join(marked, ""), "/", -1), lambda r: r != "")
    df = df.withColumn(e, F.transform(runs, _digest))
    return df.withColumn(f"{prefix}root", F.sha2(F.array_join(e, ""), 256))


def nodes(prefix: str) -> Column:
    """The distinct nodes of a tree as 64-bit numbers."""
    every = F.concat(F.array(F.col(f"{prefix}root")), F.col(f"{prefix}sections"),
                     F.col(f"{prefix}paragraphs"), F.col(f"{prefix}sentences"))
    return F.array_distinct(F.transform(every, lambda d: F.xxhash64(d)))


def likeness(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return shared.cast("double") / (F.size(a) + F.size(b) - shared)


def first_change(a: str, b: str) -> Column:
    """Position from 0 of the first paragraph in which two trees differ at the same place, null if none does."""
    pa, pb = F.col(f"{a}paragraphs"), F.col(f"{b}paragraphs")
    differs = F.zip_with(pa, pb, lambda x, y: ~x.eqNullSafe(y))
    at = F.array_position(differs, True)
    return F.when(F.col(f"{a}root") != F.col(f"{b}root"), at - 1)


def section_paragraphs(prefix: str) -> Column:
    """The paragraphs of a tree by section: ``array<struct<section, first, paragraphs>>``, ``first`` from 0."""
    p = F.col(f"{prefix}paragraphs")
    closes = lambda d: F.substring(d, 1, 1).isin("0", "1")
    # where sections end: after a closing paragraph, and after the last one
    ends = F.filter(F.transform(p, lambda d, i: F.when(closes(d) | (i == F.size(p) - 1), i + 1).otherwise(F.lit(0))), lambda i: i > 0)
    firsts = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.greatest(F.size(ends) - 1, F.lit(0))))
    return F.zip_with(F.col(f"{prefix}sections"), F.arrays_zip(firsts.alias("first"), ends.alias("end")),
                      lambda d, z: F.struct(d.alias("section"), z["first"].cast("int").alias("first"),
                                            F.slice(p, z["first"] + 1, z["end"] - z["first"]).alias("paragraphs")))


def changed_paragraphs(a: str, b: str) -> Column:
    """Positions (from 0, ascending) of the paragraphs of tree ``b`` that tree ``a`` has not got.

    Sections whose digest occurs in ``a`` are not descended into, so a paragraph put in moves nothing: only the
    section around it is looked at, and in it the paragraphs whose digests ``a`` lacks. Paragraphs that only
    moved are no change."""
    old = F.filter(F.col(f"{b}by_section"), lambda s: ~F.array_contains(F.col(f"{a}sections"), s["section"]))
    at = F.transform(old, lambda s: F.filter(
        F.transform(s["paragraphs"], lambda d, i: F.when(~F.array_contains(F.col(f"{a}paragraphs"), d), s["first"] + i)),
        lambda i: i.isNotNull()))
    return F.flatten(at)


def spans(positions: Column) -> Column:
    """Ascending positions as ``array<struct<first, last>>`` of neighbours."""
    kind = "array<struct<first:int,last:int>>"
    join = lambda runs, i: F.when(
        (F.size(runs) > 0) & (F.element_at(runs, -1)["last"] == i - 1),
        F.concat(F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0))),
                 F.array(F.struct(F.element_at(runs, -1)["first"].alias("first"), i.alias("last"))))).otherwise(
        F.concat(runs, F.array(F.struct(i.alias("first"), i.alias("last")))))
    return F.aggregate(positions, F.array().cast(kind), lambda runs, i: join(runs, i.cast("int")).cast(kind))


def locate_edits(pairs: DataFrame, before: str, after: str) -> DataFrame:
    """``pairs`` plus ``fingerprint_before``, ``fingerprint_after``, ``added`` and ``removed``: spans of
    paragraphs of the text ``after`` that ``before`` has not got, and the other way round. Null texts are empty; equal
    texts have equal fingerprints and no spans. A section holds some eight paragraphs, whatever the length of the text."""
    x, y = fresh(pairs, "x"), fresh(pairs, "y")
    d = pairs.withColumn(f"{x}text", F.coalesce(F.col(before), F.lit(""))).withColumn(f"{y}text", F.coalesce(F.col(after), F.lit("")))
    d = with_tree(with_tree(d, f"{x}text", x), f"{y}text", y)
    d = d.withColumn(f"{x}by_section", section_paragraphs(x)).withColumn(f"{y}by_section", section_paragraphs(y))
    return d.select(*[F.col(f"`{c}`") for c in pairs.columns], F.col(f"{x}root").alias("fingerprint_before"),
                    F.col(f"{y}root").alias("fingerprint_after"), spans(changed_paragraphs(x, y)).alias("added"),
                    spans(changed_paragraphs(y, x)).alias("removed"))


def neighbours(ids: DataFrame, buckets: int = 256) -> DataFrame:
    """``(k, t, n)`` rows to ``(k, t, next_k, next_t, prev_k, prev_t, prev_n)`` in ascending order, round the ends.

    A global order without a global window: rows are cut at quantiles of ``k`` into
    ``buckets`` ranges, and an id that fills a range of its own (null ids, say) by its hash ``t`` into 256 more; rows are
    numbered inside a range, and the ends of ranges meet in a small table. Only ids travel. Tables of many rows take up to 1,024 ranges.
    """
    ids = ids.distinct()
    buckets = min(1024, max(buckets, ids.count() // 1_000_000))
    steps = [i / buckets for i in range(1, buckets)]
    cuts = ids.agg(F.percentile_approx("k", steps, 10_000).alias("c")).first()["c"] or []  # at most `buckets` numbers
    hot = sorted({c for c, d in zip(cuts, cuts[1:]) if c == d})
    # a hot id begins a range, and the next id another
    cuts = sorted({*cuts, *(c + 1 for c in hot if c < 2**63 - 1)})
    limits, hot = F.lit(cuts).cast("array<long>"), F.lit(hot).cast("array<long>")
    place = F.size(F.filter(limits, lambda c: c <= F.col("k"))) if cuts else F.lit(0)
    part = F.when(F.array_contains(hot, F.col("k")), F.shiftright("t", 56)).otherwise(F.lit(0)) if cuts else F.lit(0)
    ids = cut_lineage(ids.withColumn("b", place).withColumn("s", part.cast("int")))
    me = F.struct("k", "t", "n")
    ends = ids.groupBy("b", "s").agg(F.min(me).alias("low"), F.max(me).alias("high"))
    whole = Window.partitionBy(F.lit(0)).orderBy("b", "s")
    every = Window.partitionBy(F.lit(0))
    ends = ends.select("b", "s", F.coalesce(F.lead("low").over(whole), F.min("low").over(every)).alias("after"),
                       F.coalesce(F.lag("high").over(whole), F.max("high").over(every)).alias("before"))
    w = Window.partitionBy("b", "s").orderBy("k", "t")
    return (ids.withColumn("nx", F.lead(me).over(w)).withColumn("pv", F.lag(me).over(w))
            .join(sized_broadcast(cut_lineage(ends), 64), ["b", "s"])
            .withColumn("nx", F.coalesce("nx", "after")).withColumn("pv", F.coalesce("pv", "before"))
            .select("k", "t", F.col("nx.k").alias("next_k"), F.col("nx.t").alias("next_t"),
                    F.col("pv.k").alias("prev_k"), F.col("pv.t").alias("prev_t"), F.col("pv.n").alias("prev_n")))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_chars, fingerprint, n_sections, n_paragraphs)`` per input row; a null text is empty."""
    d = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    d = with_tree(d, "_text", "_")
    return d.select(id_col, F.char_length("_text").cast("long").alias("n_chars"),
                    F.col("_root").alias("fingerprint"), F.size("_sections").alias("n_sections"),
                    F.size("_paragraphs").alias("n_paragraphs"))


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint, that of its edited text, and the likenesses.

    Edited text: the last half (rounded down) of the code points gives way to the first
    as many of the next document in ascending id (null ids first; the last row's next is the first). Rows
    equal in id and text are one document here and each get its result; rows that share an
    id only are ordered by a hash of the text. A single document is its own next.
    """
    # the id travels as its key alone, so that both uses of this table share one shuffle
    base = docs.select(id_key(F.col(id_col)).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("t", F.xxhash64("text"))
    ids = cut_lineage(base.select("k", "t", F.char_length("text").cast("long").alias("n")))
    around = cut_lineage(neighbours(ids))
    full = base.join(around.hint("merge"), ["k", "t"])
    # what the document before takes from this one; equal rows give it once
    gifts = (full.select(F.col("prev_k").alias("k"), F.col("prev_t").alias("t"),
                         F.expr("substring(text, 1, cast(prev_n div 2 as int))").alias("gift"))
             .dropDuplicates(["k", "t"]))
    full = full.join(gifts.hint("merge"), ["k", "t"])
    n = F.char_length("text")
    full = full.select("k", "t", "next_k", "next_t", "text", n.cast("long").alias("n_chars"),
                       F.expr("concat(substring(text, 1, cast(char_length(text) - char_length(text) div 2 as int)), gift)")
                       .alias("edited"))
    full = with_tree(with_tree(full, "text", "a_"), "edited", "b_")
    full = full.withColumn("own", nodes("a_"))
    made = cut_lineage(full.select(
        "k", "t", "next_k", "next_t", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.col("a_root").alias("fingerprint"), F.col("b_root").alias("edited_fingerprint"),
        likeness(F.col("own"), nodes("b_")).alias("near_edited"),
        first_change("a_", "b_").cast("long").alias("first_change"), "own"))
    nxt = (made.select(F.col("k").alias("next_k"), F.col("t").alias("next_t"), F.col("own").alias("theirs"))
           .dropDuplicates(["next_k", "next_t"]))
    return made.join(nxt, ["next_k", "next_t"]).select(
        F.when(F.col("k") != NO_ID, F.col("k")).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        likeness(F.col("own"), F.col("theirs")).alias("near_next"), "first_change")
