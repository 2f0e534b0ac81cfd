"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its lower-cased character 3-, 4- and 5-grams. Documents with and
without each n-gram are counted per class, the n-grams with the
strongest smoothed log-count ratio become features, each with that ratio as its value where it occurs, and a
logistic regression is fitted on them. Where there are more labelled rows than are fitted, rows are drawn
per class and weighed by what they stand for. Scoring looks n-grams up by hash in a
sorted table, in stretches of a text, with nothing shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, fresh, sized_broadcast

SIZES = (3, 4, 5)
#: Labelled rows used to fit the classifier, in expectation (drawn by a hash of the id, half of them of either class).
MAX_TRAIN_ROWS = 12_000
#: An n-gram needs so many training documents to be a feature, and there are so many features. They bound the model.
MIN_DOCS = 4
MAX_FEATURES = 1 << 16
#: Code points of a text that are hashed at a time.
STRETCH = 1 << 20
SMOOTHING = 1.0
#: Ranges (as a power of two) in the look-up table of feature hashes.
RANGE_BITS = 20


def gram_hashes(text: str) -> Iterator[np.ndarray]:
    """Hashes (uint64) of the n-grams of a text, in stretches, repeats included.

    A gram's hash goes on from that of its first characters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    one, two = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    longest = max(SIZES)
    for at in range(0, len(codes), STRETCH):
        part = codes[at:at + STRETCH + longest - 1].astype(np.uint64)
        h = np.zeros(min(STRETCH, len(part)), np.uint64)
        for j in range(longest):
            m = min(STRETCH, len(part) - j)
            if m <= 0:
                break
            h = (h[:m] ^ part[j:j + m]) * one
            h ^= h >> np.uint64(31)
            if j + 1 in SIZES:
                yield h * two


def gram_set(text: str) -> np.ndarray:
    parts = list(gram_hashes(text))
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


@dataclass
class ToxicityModel:
    """Feature hashes (sorted), their weights times ratios, and the intercept."""

    hashes: np.ndarray
    weights: np.ndarray
    intercept: float

    def __post_init__(self):
        # the first feature of each range of hashes, so that a look-up is one step or two
        self.shift = np.uint64(64 - RANGE_BITS)
        ranges = (self.hashes >> self.shift).astype(np.int64)
        self.first = np.full(1 << RANGE_BITS, -1, np.int32)
        self.first[ranges[::-1]] = np.arange(len(ranges) - 1, -1, -1, dtype=np.int32)
        self.most = int(np.bincount(ranges).max()) if len(ranges) else 0
        self.found = np.zeros(len(self.hashes) + self.most, bool)
        self.padded = np.concatenate((self.hashes, np.zeros(self.most, np.uint64)))

    def score(self, text: str) -> float:
        self.found[:] = False
        for h in gram_hashes(text) if self.most else ():
            at = self.first[h >> self.shift]
            some = np.flatnonzero(at >= 0)
            at, h = at[some], h[some]
            for _ in range(self.most):
                same = self.padded[at] == h
                self.found[at[same]] = True
                rest = np.flatnonzero(~same & (self.padded[at] < h))
                if not len(rest):
                    break
                at, h = at[rest] + 1, h[rest]
                inside = at < len(self.hashes)
                at, h = at[inside], h[inside]
        total = self.intercept + float(self.weights[self.found[:len(self.weights)]].sum())
        return 1 / (1 + math.exp(-total)) if total > -700 else 0.0


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", max_rows: int = MAX_TRAIN_ROWS, regularisation: float = 1e-3,
                   min_docs: int = MIN_DOCS, max_features: int = MAX_FEATURES) -> ToxicityModel:
    """Fit on labelled documents; rows without label or document are left out, an id with both labels counts for both.

    Up to ``max_rows`` labelled rows are fitted in expectation, by a hash of the id, the same in every run. A class of up to
    half as many is taken whole, the other fills the rest, and rows weigh what they stand for, so rare positives are
    not lost among many labels. Features are the ``max_features`` n-grams of the strongest ratio among those in at least
    ``min_docs`` fitted documents. Without rows of both classes every text gets the share of label 1 (0 without any row). Very
    long texts count whole, like any other; repeated rows count as often."""
    spark = docs.sparkSession
    known = (labels.select(F.col(id_col).alias("d"), F.col(label_col).cast("double").alias("y"))
             .where("d is not null and y is not null").distinct())
    n, pos = known.agg(F.count("*"), F.sum("y")).first()
    empty = np.empty(0, np.uint64), np.empty(0)
    if not n or pos in (0, n):
        rate = min(max(float(pos or 0) / max(n, 1), 1e-6), 1 - 1e-6)
        return ToxicityModel(*empty, math.log(rate / (1 - rate)))
    # of each class: its half, and what the other class leaves of the other half
    some = {1.0: pos, 0.0: n - pos}
    room = {y: max(max_rows / 2, max_rows - some[1 - y]) for y in some}
    share = {y: min(1.0, room[y] / some[y]) for y in some}
    grain = 1 << 52
    is_pos = F.col("y") == 1
    kept = F.when(is_pos, F.lit(int(share[1.0] * grain))).otherwise(F.lit(int(share[0.0] * grain)))
    # as much as it stands for, one on average
    mean = sum(some[y] * share[y] for y in some) / n
    weight = F.when(is_pos, F.lit(mean / share[1.0])).otherwise(F.lit(mean / share[0.0]))
    drawn = known.where(F.pmod(F.xxhash64("d"), F.lit(grain)) < kept).withColumn("wt", weight)
    rows = cut_lineage(docs.select(F.col(id_col).alias("d"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                       .join(sized_broadcast(drawn, 24), "d").select("text", "y", "wt"))
    rows = rows.repartition(max(8, spark.sparkContext.defaultParallelism))
    totals = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return ToxicityModel(*empty, math.log(pos / (n - pos)))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at:at + 500]
                for y in (0.0, 1.0):
                    sets = [gram_set(t) for t in part.loc[part["y"] == y, "text"]]
                    if sets:
                        h, c = np.unique(np.concatenate(sets), return_counts=True)
                        yield pd.DataFrame({"h": h.view(np.int64), "p": c * int(y), "q": c * int(1 - y)})
    grams = (rows.mapInPandas(count, "h long, p long, q long").groupBy("h")
             .agg(F.sum("p").alias("p"), F.sum("q").alias("q")).where(F.col("p") + F.col("q") >= min_docs))
    # log of (share of label-1 documents with it) / (share of label-0 documents with it)
    ratio = (F.log((F.col("p") + SMOOTHING) / (totals[1.0] + 2 * SMOOTHING))
             - F.log((F.col("q") + SMOOTHING) / (totals[0.0] + 2 * SMOOTHING)))
    best = (grams.withColumn("r", ratio).withColumn("rank", F.abs("r") * F.sqrt(F.col("p") + F.col("q")))
            .orderBy(F.desc("rank"), "h").limit(max_features).select("h", "r"))
    # written first: collected at once, the strongest of every partition would meet on the driver
    best = cut_lineage(best).toArrow()  # at most so many numbers
    hashes = best["h"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hashes, ratios = hashes[order], best["r"].to_numpy().astype(np.float64)[order]
    if not len(hashes):
        return ToxicityModel(*empty, math.log(pos / (n - pos)))
    shared = spark.sparkContext.broadcast((hashes, ratios))

    # a second Python worker beside this one's would cost a task as much memory again, so vectors are made in one step
    @F.udf(VectorUDT())
    def features(text: str):
        hs, rs = shared.value
        g = gram_set(text)
        at = np.minimum(np.searchsorted(hs, g), len(hs) - 1)
        at = np.unique(at[hs[at] == g])
        return Vectors.sparse(len(hs), at.astype(np.int32), rs[at])
    rows = cut_lineage(rows.select("y", "wt", features("text").alias("x")))
    fitted = LogisticRegression(featuresCol="x", labelCol="y", weightCol="wt", maxIter=25, regParam=regularisation,
                                standardization=False).fit(rows)
    return ToxicityModel(hashes, fitted.coefficients.toArray() * ratios, float(fitted.intercept))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus the score (0 to 1) of each whole text; a null text scores as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast((model.hashes, model.weights, model.intercept))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = ToxicityModel(*shared.value)
        for texts in batches:
            yield pd.Series([own.score(t or "") for t in texts], dtype="float64")
    return docs.withColumn(out, scored(F.col(text_col)))


def held_out(col: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves no rest by 5. A null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def toxicity_report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs(doc_id, text)``."""
    model = train_toxicity(docs, labels.where(~held_out(F.col("doc_id"))), **options)
    rows = score_toxicity(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose score is 0.5 or more; all columns stay."""
    model = train_toxicity(docs, labels.where(~held_out(F.col("doc_id"))), **options)
    score = fresh(docs, "toxic")
    return score_toxicity(docs, model, out=score).where(F.col(score) < 0.5).drop(score)
