"""Mixing sources to target weights with a min-cost flow.

Documents are aggregated by membership pattern (the set of sources a document belongs
to); only patterns and sources, never documents, reach the flow. Capacity
flows from patterns to source quotas, where the k-th use of a pattern's words costs k - 1 (convex), so
repetition is used last. Each pattern's share is then filled with whole
documents: complete passes, then one walk through a seeded order that skips a document
larger than what is open and goes on, until no document left fits.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, fresh, sized_broadcast

WORD = r"[^\x20\x09-\x0D]+"
#: The most often a document's words may be taken.
MAX_REPEATS = 3
SEED = 20
#: Bits of the hash that name a range of the seeded order, at least; large tables have ranges of some STRETCH lines.
RANGE_BITS = 10
#: Lines that one task walks at a time where the order has to be looked at closely (or one range, if larger).
STRETCH = 1024


def target_sizes(sizes: Mapping, weights: Mapping, repeats: float = MAX_REPEATS) -> dict:
    """Shares of the total by weight; a source stops at ``repeats`` times its size and its excess is shared anew."""
    left, open_, out = float(sum(sizes.values())), dict(weights), {}
    while open_:
        unit = left / sum(open_.values())
        full = [s for s, w in open_.items() if w * unit > repeats * sizes[s]]
        if not full:
            return out | {s: w * unit for s, w in open_.items()}
        for s in full:
            out[s] = float(repeats * sizes[s])
            left -= out[s]
            del open_[s]
    return out


def min_cost_flow(capacity: Mapping, member: Mapping[object, Sequence], quota: Mapping,
                  repeats: int = MAX_REPEATS) -> dict:
    """Words each pattern gives to each of its sources: ``{(pattern, source): words}``.

    Successive cheapest paths over the graph start - pattern - source - end. A
    pattern has ``repeats`` parallel edges of its capacity with costs 0, 1, 2 ...;
    a path may take words back from another source.
    """
    tiny = 1e-9 * (1 + sum(quota.values()))
    layer = {p: [0.0] * repeats for p in capacity}
    given: dict = {(p, s): 0.0 for p in capacity for s in member[p]}
    left = dict(quota)
    holders: dict = {}
    for p, s in given:
        holders.setdefault(s, []).append(p)

    def next_cost(p):
        for k in range(repeats):
            if layer[p][k] < capacity[p] - tiny:
                return k
        return None
    while True:
        # cheapest pattern with room, then breadth over exchanges (they cost nothing)
        dist, came, heap, n = {}, {}, [], 0
        for p in capacity:
            if (c := next_cost(p)) is not None:
                heapq.heappush(heap, (c, n := n + 1, ("p", p), None))
        end = None
        while heap:
            c, _, node, by = heapq.heappop(heap)
            if node in dist:
                continue
            dist[node], came[node] = c, by
            kind, x = node
            if kind == "s" and left[x] > tiny:
                end = node
                break
            for y in (member[x] if kind == "p" else [p for p in holders.get(x, ()) if given[p, x] > tiny]):
                other = ("s" if kind == "p" else "p", y)
                if other not in dist:
                    heapq.heappush(heap, (c, n := n + 1, other, node))
        if end is None:
            return given
        path = [end]
        while came[path[-1]] is not None:
            path.append(came[path[-1]])
        path.reverse()
        first = path[0][1]
        k = next_cost(first)
        amount = min(left[end[1]], capacity[first] - layer[first][k])
        for a, b in zip(path, path[1:]):
            if a[0] == "s":
                amount = min(amount, given[b[1], a[1]])
        layer[first][k] += amount
        left[end[1]] -= amount
        for a, b in zip(path, path[1:]):
            if a[0] == "p":
                given[a[1], b[1]] += amount
            else:
                given[b[1], a[1]] -= amount


def share_out(capacity: Mapping, member: Mapping[object, Sequence], quota: Mapping, repeats: int = MAX_REPEATS) -> dict:
    """``min_cost_flow``, taken apart: a source that shares no pattern is filled as it stands, and only
    patterns that overlap meet in a flow, each group of them in its own."""
    shared = {s for p in capacity if len(member[p]) > 1 for s in member[p]}
    given = {(p, s): min(float(quota[s]), float(repeats * capacity[p])) for p in capacity for s in member[p] if s not in shared}
    root = {s: s for s in shared}

    def find(s):
        while root[s] != s:
            root[s] = s = root[root[s]]
        return s
    for p in capacity:
        if len(member[p]) > 1:
            for s in member[p][1:]:
                root[find(s)] = find(member[p][0])
    groups: dict = {}
    for p in capacity:
        if any(s in shared for s in member[p]):
            groups.setdefault(find(member[p][0]), []).append(p)
    for some in groups.values():
        sources = {s for p in some for s in member[p]}
        given |= min_cost_flow({p: capacity[p] for p in some}, {p: member[p] for p in some}, {s: quota[s] for s in sources}, repeats)
    return given


def _numbered(rows: DataFrame, keys: Sequence[str], part: str, out: str) -> DataFrame:
    """``rows`` numbered from 1 among those of equal ``keys``: within a part first, parts summed up, so that no
    window holds more than one part of a key. ``part`` is a stored column."""
    counts = rows.groupBy(*keys, part).agg(F.count("*").alias(f"{out}_n"))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, part, F.coalesce(F.sum(f"{out}_n").over(before), F.lit(0)).alias(f"{out}_o"))
    inside = Window.partitionBy(*keys, part).orderBy(F.lit(0))
    return (rows.join(offsets, [*keys, part]).withColumn(out, F.row_number().over(inside) + F.col(f"{out}_o")).drop(f"{out}_o"))


def mix(docs: DataFrame, member: Column, size: Column, targets, order: Sequence[Column],
        repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """``docs`` plus ``_size`` (long), ``_pattern`` (array) and ``_copies`` (0 to ``repeats``).

    ``member``: array of a document's sources (nulls allowed inside); ``targets``: function of
    ``{source: words}`` to ``{source: target words}``. ``order`` makes rows distinguishable; equal
    rows may swap copies. What the driver sees is a row per pattern. Columns of the names above are replaced."""
    # null sources get a name of their own, so that sets of sources compare
    named = F.array_sort(F.transform(F.array_distinct(member), lambda s: F.when(s.isNull(), "n").otherwise(F.concat(F.lit("s"), s))))
    rows = docs.withColumn("_size", size.cast("long")).withColumn("_pattern", named)
    rows = rows.withColumn("_u", F.shiftrightunsigned(F.xxhash64(F.lit(seed), *order), 1))
    rows = cut_lineage(rows.withColumn("_part", F.spark_partition_id()))
    per_pattern = rows.groupBy("_pattern").agg(F.sum("_size").alias("w"), F.count("*").alias("n")).collect()
    bits = max(RANGE_BITS, (sum(r["n"] for r in per_pattern) // STRETCH).bit_length())
    rows = rows.withColumn("_range", F.shiftright("_u", 63 - bits))
    capacity = {tuple(r["_pattern"]): float(r["w"]) for r in per_pattern}
    name = lambda s: None if s == "n" else s[1:]
    sizes: dict = {}
    for p, w in capacity.items():
        for s in p:
            sizes[name(s)] = sizes.get(name(s), 0.0) + w
    quota = targets(sizes)
    flow = share_out(capacity, {p: [name(s) for s in p] for p in capacity}, quota, repeats)
    total: dict = {}
    for (p, _), w in flow.items():
        total[p] = total.get(p, 0.0) + w
    plan, rest = [], {}
    for i, (p, w) in enumerate(total.items()):
        passes = min(repeats, int(math.floor(w / capacity[p] + 1e-9))) if capacity[p] else 1
        left = round(w - passes * capacity[p]) if passes < repeats else 0
        plan.append((list(p), i, passes, left))
        if left > 0:
            rest[i] = left
    spark = docs.sparkSession
    plan = spark.createDataFrame(plan, "_pattern array<string>, _p int, _passes int, _rest long")
    numbered = rows.join(sized_broadcast(plan, 200), "_pattern")
    # equal rows are one line with their number
    lines = (numbered.where((F.col("_rest") > 0) & (F.col("_size") > 0))
             .groupBy("_p", "_range", "_u", "_size").agg(F.count("*").alias("_m")))
    lines = cut_lineage(lines)
    steps, first, walked = _walk_order(lines, rest, 1 << bits)
    whole = spark.createDataFrame([(i, first.get(i, 2**63 - 1), steps[i]) for i in rest],
                                  "_p int, _first long, _steps array<struct<after:long,stop:long,open:long>>")
    whole = sized_broadcast(whole, 200)
    inside = F.exists("_steps", lambda s: (F.col("_range") > s["after"]) & (F.col("_range") < s["stop"]) & (F.col("_size") <= s["open"]))
    walked = walked.where("_k > 0").select("_p", "_u", "_size", "_k", "_m")
    walked = cut_lineage(_topped_up(lines, whole, inside, walked, rest))
    out = (numbered.join(whole, "_p", "left")
           .join(sized_broadcast(walked, 40), ["_p", "_u", "_size"], "left"))
    taken = F.when(F.col("_size") == 0, F.col("_u") < F.col("_first")).otherwise(inside | F.coalesce(F.col("_k") == F.col("_m"), F.lit(False)))
    if walked.where("_k < _m").take(1):  # some of several equal rows
        some = F.col("_k") < F.col("_m")
        nth = _numbered(out.where(some), ["_p", "_u", "_size"], "_part", "_nth")
        out = (out.where(F.coalesce(~some, F.lit(True))).withColumn("_in", taken)
               .unionByName(nth.withColumn("_in", F.col("_nth") <= F.col("_k")).drop("_nth")))
    else:
        out = out.withColumn("_in", taken)
    extra = F.coalesce(F.col("_in"), F.lit(False)).cast("int")
    return (out.withColumn("_copies", (F.col("_passes") + extra).cast("int"))
            .drop("_u", "_range", "_part", "_p", "_passes", "_rest", "_first", "_steps", "_k", "_m", "_in"))


def _topped_up(lines: DataFrame, whole: DataFrame, inside: Column, walked: DataFrame, rest: Mapping) -> DataFrame:
    """``walked`` with one row more of the smallest line that is not all in, where that leaves a pattern nearer to its words."""
    at = lines.join(whole, "_p").join(walked.select("_p", "_u", "_size", "_k"), ["_p", "_u", "_size"], "left")
    at = at.withColumn("_k", F.when(inside, F.col("_m")).otherwise(F.coalesce("_k", F.lit(0))))
    open_ = F.when(F.col("_k") < F.col("_m"), F.struct("_size", "_u", "_k", "_m"))
    found = at.groupBy("_p").agg(F.sum(F.col("_k") * F.col("_size")).alias("took"), F.min(open_).alias("next")).collect()  # a row per pattern
    more = [(r["_p"], r["next"]["_u"], r["next"]["_size"], r["next"]["_k"] + 1, r["next"]["_m"]) for r in found
            if r["next"] is not None and r["next"]["_size"] < 2 * (rest[r["_p"]] - r["took"])]
    if not more:
        return walked
    more = sized_broadcast(lines.sparkSession.createDataFrame(more, "_p int, _u long, _size long, _k long, _m long"), 40)
    return walked.join(more.select("_p", "_u", "_size"), ["_p", "_u", "_size"], "left_anti").unionByName(more)


def _walk_order(lines: DataFrame, rest: Mapping, ranges: int) -> tuple[dict, dict, DataFrame]:
    """First fit through the seeded order of ``lines(_p, _range, _u, _size, _m)`` for ``rest`` words of each ``_p``.

    Returns ``{p: [(after, stop, open)]}``: between the ranges ``after`` and ``stop`` all lines of up to
    ``open`` words are in; ``{p: hash}`` of the first line that did not fit; and the lines of the ranges between
    these stretches with ``_k`` of their ``_m`` rows taken. A round sums up the ranges of the lines that fit, takes the
    ranges before the quota runs out and walks the next stretch line by line; a few rounds
    do, as what is open is soon less than a document, and ranges bound their number."""
    spark = lines.sparkSession
    steps: dict = {p: [] for p in rest}
    first: dict = {}
    state = {p: (-1, w) for p, w in rest.items()}
    walked = spark.createDataFrame([], "_p int, _u long, _size long, _m long, _k long, _open long")
    while state:
        at = spark.createDataFrame([(p, *x) for p, x in state.items()], "_p int, _after long, _open long")
        fits = lines.join(sized_broadcast(at, 24), "_p").where("_range > _after and _size <= _open")
        sums = fits.groupBy("_p", "_open", "_range").agg(F.sum(F.col("_size") * F.col("_m")).alias("w"), F.count("*").alias("n"))
        order, every = Window.partitionBy("_p").orderBy("_range"), Window.partitionBy("_p")
        sums = sums.withColumn("to", F.sum("w").over(order)).withColumn("lines", F.sum("n").over(order))
        over = F.when(F.col("to") > F.col("_open"), F.struct("_range", (F.col("to") - F.col("w")).alias("before"),
                                                             (F.col("lines") - F.col("n")).alias("skip")))
        sums = sums.withColumn("stop", F.min(over).over(every))
        near = F.when((F.col("_range") == F.col("stop._range")) |
                      ((F.col("_range") > F.col("stop._range")) & (F.col("lines") - F.col("stop.skip") <= STRETCH)), F.col("_range"))
        found = {r["_p"]: r for r in sums.where("stop is not null").groupBy("_p", "stop").agg(F.max(near).alias("last")).collect()}
        for p, (after, open_) in state.items():
            steps[p].append((after, found[p]["stop"]["_range"] if p in found else ranges, open_))
        if not found:
            break
        at = spark.createDataFrame([(p, r["stop"]["_range"], r["last"], state[p][1] - r["stop"]["before"]) for p, r in found.items()],
                                   "_p int, _from long, _to long, _open long")
        near = lines.join(sized_broadcast(at, 32), "_p").where("_range between _from and _to and _size <= _open")
        part = cut_lineage(near.select("_p", "_u", "_size", "_m", "_open").groupBy("_p").applyInPandas(_walk, walked.schema))
        # a stretch of which no line fits any more leaves what is open as it was
        after = {r["_p"]: r for r in part.groupBy("_p").agg(
            F.min("_open").alias("open"), F.min(F.when(F.col("_k") < F.col("_m"), F.col("_u"))).alias("u")).collect()}
        state = {}
        for p, r in found.items():
            open_ = after[p]["open"] if p in after else steps[p][-1][2] - r["stop"]["before"]
            if p in after and after[p]["u"] is not None:
                first.setdefault(p, after[p]["u"])
            if open_ > 0:
                state[p] = (r["last"], open_)
        walked = walked.unionByName(part)
    return steps, first, walked


def _walk(part: pd.DataFrame) -> pd.DataFrame:
    """Lines in order: as many of the equal rows as fit, ``_open`` is what is left after them."""
    part = part.sort_values(["_u", "_size"])
    open_, taken, left = int(part["_open"].iloc[0]), [], []
    for size, m in zip(part["_size"].tolist(), part["_m"].tolist()):
        taken.append(min(m, open_ // size))
        open_ -= taken[-1] * size
        left.append(open_)
    return part.assign(_k=taken, _open=left)[["_p", "_u", "_size", "_m", "_k", "_open"]]


def source_weights(sources: Sequence) -> dict:
    """1, 2, 3, 1, ... for the sources by code point, null last."""
    ordered = sorted((s for s in sources if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sources)
    return {s: float(i % 3 + 1) for i, s in enumerate(ordered)}


def source_targets(sizes: Mapping) -> dict:
    return target_sizes(sizes, source_weights(list(sizes)))


def mix_report(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` per row of ``docs(doc_id, text, source)``.

    A null text has size 0. Sources without a word have target 0. Rows that share an id are told apart by text."""
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("_t"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = cut_lineage(rows)
    mixed = mix(rows, F.array("source"), F.col("size"), source_targets,
                [F.col("doc_id"), F.col("_t")])
    per = {r["source"]: float(r["n"]) for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    aim = source_targets(per)
    table = docs.sparkSession.createDataFrame([(s, int(per[s]), float(aim[s])) for s in per],
                                              "_source string, source_size long, target double")
    out = mixed.join(sized_broadcast(table, 100), mixed["source"].eqNullSafe(table["_source"]))
    return out.select("doc_id", "size", "source_size", "target", (F.col("_size") * F.col("_copies")).alias("taken"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (0 to 3 times); all columns stay.

    A null text has size 0; an empty table stays empty. Rows equal in id, source and text share what the mix takes of them
    together: each comes equally often, and as many as remain once more."""
    d, src, t, w, rows, copies, part, nth, each = (fresh(docs, x) for x in "d s t w rows copies part nth each".split())
    light = docs.select(F.col("doc_id").alias(d), F.col("source").alias(src), F.xxhash64("text").alias(t),
                        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias(w))
    mixed = mix(light, F.array(src), F.col(w), source_targets, [F.col(d), F.col(t)])
    # equal rows: one line with their number and their copies in total
    found = cut_lineage(mixed.groupBy(d, src, t).agg(F.count("*").alias(rows), F.sum("_copies").alias(copies)).where(F.col(copies) > 0))
    cols = docs.columns
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found[d]) & docs["source"].eqNullSafe(found[src])
                       & (F.xxhash64(docs["text"]) == found[t]))
    joined = joined.withColumn(each, F.floor(F.col(copies) / F.col(rows)).cast("int"))
    uneven = found.where(F.col(copies) % F.col(rows) != 0)
    if uneven.take(1):
        even = joined.where(F.col(copies) % F.col(rows) == 0).select(*[F.col(f"`{c}`") for c in cols], each)
        some = cut_lineage(joined.where(F.col(copies) % F.col(rows) != 0).withColumn(part, F.spark_partition_id()))
        # nulls of the keys are values here
        keys = {f"{nth}{i}": F.struct(c) for i, c in enumerate((d, src))}
        some = _numbered(some.withColumns(keys), [*keys, t], part, nth)
        some = some.withColumn(each, F.col(each) + (F.col(nth) <= F.col(copies) % F.col(rows)).cast("int"))
        joined = even.unionByName(some.select(*[F.col(f"`{c}`") for c in cols], each))
    return (joined.where(F.col(each) > 0)
            .withColumn(part, F.explode(F.sequence(F.lit(1), F.col(each)))).select(*[F.col(f"`{c}`") for c in cols]))
