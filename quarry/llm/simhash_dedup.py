"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints are made in Arrow batches, one document at a time. Distinct fingerprints
meet in buckets: 64 bits in five blocks, and two fingerprints within 3 bits agree in at least two
blocks, so the ten pairs of blocks are the bucket keys and no link is missed. Inside
a run of sorted buckets the bits are stored as vertical planes; the planes shifted by s
rows against themselves give the differing bits of all rows s apart, 64 pairs a machine word,
which carry-save counters add up until every pair is past the radius.
A bucket larger than ``chunk`` is dealt out as pairs of chunks to many tasks. Tasks return spanning
links only, and a component step joins them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import components, cut_lineage, fresh, id_key

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Widths of the five blocks, low bits first.
BLOCKS = (13, 13, 13, 13, 12)
#: Bucket rows that one task compares at a time.
CHUNK = 8192
#: Shingles hashed at a time within one document.
PIECE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included.

    Words are runs without blanks, A-Z lower-cased; fewer words than ``shingle`` are one
    shingle; no word gives 0. A bit is 1 if over half of the XXH64 values have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    blank = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], blank + 1))
    ends = np.concatenate((blank, [len(joined)]))
    n = len(words) - width + 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, PIECE):
        to = min(n, at + PIECE)
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in
                         zip(starts[at:to].tolist(), ends[at + width - 1:to + width - 1].tolist())), "<u8", to - at)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, text_col: str, out: str, shingle: int = SHINGLE) -> DataFrame:
    @F.pandas_udf(LongType())
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return docs.withColumn(out, fp(F.col(text_col)))


def planes(values: np.ndarray) -> np.ndarray:
    """(64, words) bit planes of uint64 values; row r is bit r % 64 of word r // 64."""
    n = -(-len(values) // 64) * 64
    padded = np.zeros(n, "<u8")
    padded[:len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def bit_words(flags: np.ndarray) -> np.ndarray:
    n = -(-len(flags) // 64) * 64
    padded = np.zeros(n, np.uint8)
    padded[:len(flags)] = flags
    return np.packbits(padded, bitorder="little").view("<u8")


def close_at(p: np.ndarray, s: int, pairs: np.ndarray, radius: int) -> np.ndarray:
    """Rows r of ``pairs`` (flags for r against r + s) within the radius, by carry-save counting."""
    valid = bit_words(pairs)
    words = np.flatnonzero(valid)
    if not len(words):
        return words
    step, low = divmod(s, 64)
    wide = np.concatenate((p, np.zeros((64, step + 2), "<u8")), axis=1) if words[-1] + step + 1 >= p.shape[1] else p
    slices = max(1, radius.bit_length())
    counters = [np.zeros(len(words), "<u8") for _ in range(slices)]
    over = ~valid[words]
    for bit in range(64):
        row = wide[bit]
        other = row[words + step] >> np.uint64(low) if low else row[words + step]
        if low:
            other = other | (row[words + step + 1] << np.uint64(64 - low))
        carry = row[words] ^ other
        for c in counters:
            carry, c[:] = c & carry, c ^ carry
        over |= carry
        if bit % 8 == 7 and (over == np.uint64(2**64 - 1)).all():
            return np.empty(0, np.int64)
    if radius != (1 << slices) - 1:
        # counts of 0 .. 2**slices - 1: bit by bit, which exceed the radius
        above, equal = np.zeros(len(words), "<u8"), np.full(len(words), 2**64 - 1, "<u8")
        for j in reversed(range(slices)):
            if radius >> j & 1:
                equal &= counters[j]
            else:
                above |= equal & counters[j]
                equal &= ~counters[j]
        over |= above
    found = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    w, b = np.nonzero(found)
    return words[w] * 64 + b


def spanning_links(keys: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span what is within ``radius`` inside each run of equal ``keys`` (sorted).

    Returns (row, row of its class) for rows that are not first in their class."""
    n = len(values)
    parent = np.arange(n)
    if n < 2:
        return parent[:0], parent[:0]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.concatenate((new, [n])))
    ends = np.repeat(new + sizes, sizes)
    alive = np.flatnonzero(ends - np.arange(n) > 1)
    p = planes(values)
    s = 1
    while len(alive):
        flags = np.zeros(n, np.uint8)
        flags[alive] = 1
        i = close_at(p, s, flags, radius)
        a, b = i, i + s
        while len(a):
            ra, rb = parent[a], parent[b]
            differ = ra != rb
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            if not len(a):
                break
            parent[np.maximum(ra, rb)] = np.minimum(ra, rb)
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
        s += 1
        alive = alive[ends[alive] - alive > s]
    rows = np.flatnonzero(parent != np.arange(n))
    return rows, parent[rows]


def links(prints: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """Distinct ``fp`` values to links ``(u, v)`` that span every pair within ``radius`` (at most 3)."""
    if not 0 <= radius <= len(BLOCKS) - 2:
        raise ValueError("five blocks find links of 3 bits at most")
    low, masks = 0, []
    for width in BLOCKS:
        masks.append(((1 << width) - 1) << low)
        low += width
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(a | b))).alias("value"))
        for i, (a, b) in enumerate(combinations(masks, 2))])).alias("x")).select("fp", "x.part", "x.value")
    counts = (keyed.groupBy("part", "value").agg(F.count("*").alias("n")).where("n > 1")
              .withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int")))
    rows = keyed.join(counts, ["part", "value"]).withColumn("c", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    # one chunk: the bucket itself; more: every pair of chunks, which also covers pairs within a chunk
    other = F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda i: i != F.col("c")))
    rows = rows.select("fp", "part", "value", "c", F.explode(other).alias("o"))
    rows = rows.select("fp", F.xxhash64("part", "value", F.least("c", "o"), F.greatest("c", "o")).alias("bucket"))
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def found(part: pd.DataFrame) -> pd.DataFrame:
            v = part["fp"].to_numpy(np.int64)
            r, to = spanning_links(part["bucket"].to_numpy(np.int64), v.view(np.uint64), radius)
            return pd.DataFrame({"u": v[r], "v": v[to]})
        for batch in batches:
            last = batch["bucket"].iloc[-1] if len(batch) else None
            if last is None:
                continue
            open_ = (batch["bucket"] == last).to_numpy()
            if not open_.all() or (held and held[-1]["bucket"].iloc[-1] != last):
                yield found(pd.concat([*held, batch[~open_]]))
                held = []
            held.append(batch[open_])  # one bucket, at most two chunks
        if held:
            yield found(pd.concat(held))
    return dealt.mapInPandas(compare, "u long, v long").distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """``(id, fingerprint, component_id)`` per input row.

    Documents whose fingerprints differ in ``radius`` bits or fewer are linked; ``component_id`` is the smallest id
    reachable over links. Null, empty and
    blank texts have fingerprint zero and link like any other. A null id counts as the
    smallest and comes back as a null component. Other columns are ignored.
    """
    prints = docs.select(id_key(F.col(id_col)).alias("k"), F.col(text_col).alias("text"))
    prints = cut_lineage(with_fingerprint(prints, "text", "fp", shingle).select("k", "fp"))
    labelled = _rooted(prints, F.col("k"), radius, chunk)
    labelled = (labelled.join(labelled.groupBy("root").agg(F.min("least").alias("component")), "root")
                .select("fp", "component"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    real = lambda c: F.when(F.col(c) != id_key(F.lit(None)), F.col(c))
    return prints.join(labelled, "fp").select(
        real("k").alias(id_col), hexed.alias("fingerprint"), real("component").alias("component_id"))


def _rooted(prints: DataFrame, least, radius: int, chunk: int) -> DataFrame:
    """``(fp, least, root)``: the least value and the component of each distinct fingerprint of ``prints``."""
    classes = cut_lineage(prints.groupBy("fp").agg(F.min(least).alias("least")))
    roots = components(links(classes.select("fp"), radius, chunk))
    return (classes.join(roots, classes["fp"] == roots["node"], "left")
            .select("fp", "least", F.coalesce("root", "fp").alias("root")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that of the smallest id; all columns stay.

    A null id counts as the smallest. Of rows that share the smallest id of a group, the one with the
    least hash of all columns stays; other groups with rows of this id keep a row of their own."""
    # the flags tell nulls apart, which the hash skips
    whole = F.xxhash64(*[x for c in docs.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])
    prints = docs.select(id_key(F.col(id_col)).alias("k"), whole.alias("h"), F.col(text_col).alias("text"))
    prints = cut_lineage(with_fingerprint(prints, "text", "fp", shingle).select("k", "h", "fp"))
    k, h, n = (fresh(docs, x) for x in "khn")
    chosen = (_rooted(prints, F.struct("k", "h"), radius, chunk).groupBy("root").agg(F.min("least").alias("r"))
              .select(F.col("r.k").alias(k), F.col("r.h").alias(h)))
    rows = prints.groupBy("k", "h").agg(F.count("*").alias(n))
    chosen = cut_lineage(chosen.join(rows, (F.col(k) == rows["k"]) & (F.col(h) == rows["h"])).select(k, h, n))
    kept = docs.join(chosen, (id_key(docs[id_col]) == chosen[k]) & (whole == chosen[h]))
    once = kept.where(F.col(n) == 1).drop(k, h, n)
    if not chosen.where(F.col(n) > 1).take(1):
        return once
    # rows that are equal in all columns: one of them
    return once.unionByName(kept.where(F.col(n) > 1).dropDuplicates([k, h]).drop(k, h, n))
