"""Periodic runs of words: recursive frequency splitting, then lag scans of what survives.

A run is a longest stretch of words with smallest period q (words q apart are the same) and a length of at
least ``max(MIN_LENGTH, MIN_REPEATS * q)``. Each of its words occurs ``MIN_REPEATS`` times or more inside it, so a word
that is rarer than that in a segment lies in no run there: it splits the segment, and the
parts are counted anew until no word is rare. Segments that survive are scanned lag by lag. The words of a
run agree with those q further on over a stretch that contains an eight-word gram at
one of the lag's check points, so only these are compared, and a hit is extended by the ranks
of grams of 1, 2, 4 ... words. Nothing is left out: check points are spaced by what a run must cover.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

MIN_LENGTH = 24
MIN_REPEATS = 3
#: Words of the gram compared at a check point; a run's matching stretch has at least twice as many.
GRAM = 8
#: Longest grams that are ranked, as a power of two: longer extensions go step by step.
LEVELS = 10
#: A segment of up to so many words is scanned at all lags in one go.
SHORT = 4096
#: Check points compared at a time.
CHECKS = 1 << 20


def surviving_segments(ids: np.ndarray) -> list[tuple[int, int]]:
    """``[(from, to)]`` of the segments of at least MIN_LENGTH words in which every word occurs MIN_REPEATS times.

    The longest part of a split segment goes on with its counts less those of the
    other parts, which are counted as segments of their own: a word is counted anew log-many times."""
    out, todo = [], [(0, ids)] if len(ids) >= MIN_LENGTH else []
    while todo:
        base, seq = todo.pop()
        seq = np.unique(seq, return_inverse=True)[1]
        counts = np.bincount(seq)
        rare = np.flatnonzero(counts[seq] < MIN_REPEATS)
        order = first = None
        a, b = 0, len(seq)
        while len(rare):
            edges = np.concatenate(([a - 1], rare, [b]))
            sizes = np.diff(edges) - 1
            longest = int(sizes.argmax())
            for i in np.flatnonzero(sizes >= MIN_LENGTH):
                if i != longest:
                    todo.append((base + int(edges[i]) + 1, seq[edges[i] + 1:edges[i + 1]]))
            left, right = int(edges[longest]) + 1, int(edges[longest + 1])
            if right - left < MIN_LENGTH:
                a = b = 0
                break
            gone, times = np.unique(np.concatenate((seq[a:left], seq[right:b])), return_counts=True)
            a, b = left, right
            counts[gone] -= times
            gone = gone[(counts[gone] > 0) & (counts[gone] < MIN_REPEATS)]
            if order is None:
                order = np.argsort(seq, kind="stable")
                first = np.searchsorted(seq[order], np.arange(len(counts) + 1))
            rare = [order[first[w]:first[w + 1]] for w in gone.tolist()]
            rare = np.sort(np.concatenate([p[(p >= a) & (p < b)] for p in rare])) if rare else gone[:0]
        if b > a:
            out.append((base + a, base + b))
    return sorted(out)


def gram_ranks(seq: np.ndarray) -> list[np.ndarray]:
    """For grams of 1, 2, 4 ... words: a number per position, equal for equal grams (at least up to GRAM words)."""
    ranks, width = [np.unique(seq, return_inverse=True)[1].astype(np.int64)], 1
    while 2 * width <= min(1 << LEVELS, max(GRAM, len(seq) // 4)):
        r = ranks[-1]
        ranks.append(np.unique(r[:-width] * (int(r.max()) + 1) + r[width:], return_inverse=True)[1])
        width *= 2
    return ranks


def _reach(ranks: list[np.ndarray], at: np.ndarray, lag: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on (``step`` 1) or before it (-1) equal the words ``lag`` further on."""
    n, done = len(ranks[0]), np.zeros(len(at), np.int64)
    active = np.arange(len(at))
    for level in reversed(range(len(ranks))):
        width, r = 1 << level, ranks[level]
        while len(active):
            i = at[active] + done[active] if step > 0 else at[active] - done[active] - width
            j = i + lag[active]
            ok = (j + width <= n) if step > 0 else (i >= 0)
            ok[ok] = r[i[ok]] == r[j[ok]]
            if not ok.any():
                break
            done[active[ok]] += width
            active = active[ok]
        active = np.arange(len(at))
    return done


def scan_lags(seq: np.ndarray) -> list[tuple[int, int, int]]:
    """``[(start, length, period)]`` of all runs of a segment, by start, then period."""
    m, found = len(seq), {}
    if m < MIN_LENGTH:
        return []
    ranks = gram_ranks(seq)
    gram = ranks[GRAM.bit_length() - 1]
    cover, periods = np.full(m, -1, np.int64), []
    low, top = 1, m // MIN_REPEATS
    while low <= top:
        high = top if m <= SHORT else min(top, 2 * low - 1)
        fresh_runs = []
        for lag, at in _hits(gram, low, high):
            if periods:
                # inside a known run whose period divides the lag there is nothing new
                run = cover[at]
                known = (run >= 0) & (cover[at + lag + GRAM - 1] == run)
                known[known] = lag[known] % np.array(periods)[run[known]] == 0
                lag, at = lag[~known], at[~known]
            if not len(at):
                continue
            start = at - _reach(ranks, at, lag, -1)
            length = at + _reach(ranks, at, lag, 1) - start + lag
            good = length >= np.maximum(MIN_LENGTH, MIN_REPEATS * lag)
            fresh_runs += zip(lag[good].tolist(), start[good].tolist(), length[good].tolist())
        for q, s, n in sorted(set(fresh_runs)):
            if (s, n) not in found:  # the smallest period comes first
                found[s, n] = q
                cover[s:s + n] = len(periods)
                periods.append(q)
        low = high + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def _hits(gram: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(lag, position) of the check points of the lags ``low`` to ``high`` where equal grams start."""
    lags = np.arange(low, high + 1)
    # positions whose gram must lie in the stretch that matches: one in each so many
    stride = np.maximum(MIN_LENGTH - lags, (MIN_REPEATS - 1) * lags) - GRAM + 1
    room = len(gram) - lags
    lags, stride, room = lags[room > 0], stride[room > 0], room[room > 0]
    checks = -(-room // stride)
    ends = np.cumsum(checks)
    at = 0
    while at < len(lags):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + CHECKS, "right")))
        lag = np.repeat(lags[at:to], checks[at:to])
        nth = np.arange(len(lag)) - np.repeat(ends[at:to] - checks[at:to] - before, checks[at:to])
        pos = nth * np.repeat(stride[at:to], checks[at:to])
        hit = gram[pos] == gram[pos + lag]
        yield lag[hit], pos[hit]
        at = to


def text_words(text: str | None) -> list[bytes]:
    """Words: what lies between blanks (space, tab, newlines, form feed)."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def find_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a list of words, by start, then period."""
    if len(words) < MIN_LENGTH:
        return []
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    runs = [(a + s, n, q) for a, b in surviving_segments(ids) for s, n, q in scan_lags(ids[a:b])]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words joined by blanks, without those that a run holds after its first period."""
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        for s, n, q in runs:
            edge[s + q] += 1
            edge[s + n] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return b" ".join(words).decode("utf-8", "surrogatepass")


_RESULT = "n_words long, start array<long>, length array<long>, period array<long>, collapsed string"


def collapse_runs(docs: DataFrame, text_col: str | Column = "text") -> DataFrame:
    """``docs`` plus ``n_words`` (long), ``runs`` (array of ``start, length, period``, by start, then period)
    and ``collapsed`` (the words left, joined by one blank); columns of these names are replaced.

    Every row is judged for itself, whole, with nothing shuffled. A null, empty or blank text has no
    words, no runs and an empty ``collapsed``; repeated rows get equal results; an empty table gives an empty
    one. A very long text is one row's work, n log n in its words."""
    @F.pandas_udf(_RESULT)
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            rows = []
            for text in part:
                words = text_words(text)
                runs = find_runs(words)
                rows.append((len(words), *([r[i] for r in runs] for i in range(3)), collapse(words, runs)))
            yield pd.DataFrame(rows, columns=["n_words", "start", "length", "period", "collapsed"])
    tmp = fresh(docs, "found")
    column = F.col(text_col) if isinstance(text_col, str) else text_col
    out = docs.withColumn(tmp, found(column))
    runs = F.arrays_zip(*[F.col(tmp)[c].alias(c) for c in ("start", "length", "period")])
    return (out.withColumn("n_words", F.col(tmp)["n_words"]).withColumn("runs", runs)
            .withColumn("collapsed", F.col(tmp)["collapsed"]).drop(tmp))


def planted(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text, of one in ten documents with a periodic tail: for h = crc32 of the decimal id and g = h div 10,
    documents with h mod 10 = 0 repeat from word ``g mod n`` on with period ``1 + (n - a) div (3 + g mod 8)``.

    A null id plants nothing; a null or blank text stays as it is."""
    h = F.crc32(F.col(id_col).cast("long").cast("string").cast("binary"))

    @F.pandas_udf("string")
    def edit(texts: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series([t if pd.isna(x) or x % 10 else plant(t, int(x) // 10) for t, x in zip(texts, hashes)], dtype=object)
    return edit(F.col(text_col), h)


def plant(text: str | None, g: int) -> str | None:
    words = text_words(text)
    if not (n := len(words)):
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    tail = (unit * (-(-(n - a) // p)))[:n - a]
    return b" ".join(words[:a] + tail).decode("utf-8", "surrogatepass")


def run_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of ``collapse_runs`` over the planted texts: one row per row of ``docs``.

    The named run has the greatest exact ``length / period`` (ties: smallest start, then period); without a run
    its four columns are null."""
    d = docs.select(F.col(id_col).alias("doc_id"), planted(id_col, text_col).alias("text"))
    d = collapse_runs(d).select("doc_id", "runs", "collapsed")
    better = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]  # noqa: E731  (runs are in order)
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(better(b, a), b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                     r["period"].cast("string")))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    d = d.withColumn("best", best)
    return d.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                    F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
                    F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
