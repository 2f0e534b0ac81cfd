"""URL filter: host and path rules first, gradient-boosted trees for the rest.

The trees see lexical features only (lengths, depth, digit ratio, entropy,
parameter counts, suffix statistics) and are trained from labelled URLs. In the
registered query the labelled URLs are those that the rules decide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, cut_lineage, exploded, sized_broadcast

#: Labelled rows used to fit the trees, in expectation (drawn by a hash of the URL, half of them of either class).
MAX_TRAIN_ROWS = 20_000
#: Suffixes whose block rate is kept as a feature; rarer ones share one rate.
MIN_SUFFIX_ROWS = 5

FEATURES = ("f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digits", "f_hyphens",
            "f_entropy", "f_params", "f_query_length", "f_fragment", "f_secure", "f_suffix1", "f_suffix2")


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both empty without ``://`` or for a null URL."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    df = df.withColumn("_rest", F.coalesce(rest, F.lit("")))
    df = df.withColumn("_h", F.regexp_extract("_rest", "^[^/?#]*", 0))
    path = F.regexp_extract(F.expr("substring(_rest, char_length(_h) + 1)"), "^[^?#]*", 0)
    return (df.withColumn("path", path).withColumn("host", F.translate("_h", UPPER, UPPER.lower()))
            .drop("_rest", "_h"))


def host_suffixes(labels: str, deepest: int) -> Column:
    """Labels ``[a, b, c]`` of a host to ``[c, b.c, a.b.c]``, of up to ``deepest`` labels: as many as the longest rule host has."""
    n = F.size(labels)
    upto = F.least(n, F.lit(max(deepest, 1)))
    return F.transform(F.sequence(F.lit(1), upto), lambda i: F.array_join(F.slice(labels, n - i + 1, i), "."))


def match_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """Longest rule for each distinct ``(host, path)``: ``(host, path, rule, rule_verdict)`` where one fits.

    Equi-joins only: a host's suffixes meet the lengths of rule paths known for
    them, then the path's prefixes of those lengths meet the rules, so many
    rules on one host are never tried one by one. Equally long rules: the smaller string.
    """
    rules = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict").distinct()
    lengths = rules.groupBy("rule_host").agg(F.collect_set(F.char_length("rule_path")).alias("lengths"))
    named = places.select("host", "path", F.split("host", "[.]", -1).alias("labels"))
    deepest = rules.agg(F.max(F.size(F.split("rule_host", "[.]", -1)))).first()[0] or 0
    named = named.select("host", "path", host_suffixes("labels", deepest).alias("all"))
    keyed = (exploded(named, "all", "rule_host", "i").drop("i")
             .join(sized_broadcast(lengths, 64), "rule_host")
             .select("host", "path", "rule_host", F.explode("lengths").alias("n"))
             .where(F.char_length("path") >= F.col("n"))
             .withColumn("rule_path", F.expr("substring(path, 1, n)")))
    hit = keyed.join(sized_broadcast(rules, 256), ["rule_host", "rule_path"])
    rule = F.concat("rule_host", "rule_path")
    best = F.min(F.struct(-F.char_length(rule), rule.alias("rule"), F.col("verdict").alias("v")))
    return (hit.groupBy("host", "path").agg(best.alias("best"))
            .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.v").alias("rule_verdict")))


def with_features(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds the lexical features that need no statistics. Needs ``host`` and ``path``."""
    u = F.coalesce(F.col(url), F.lit(""))
    n = F.char_length(u)
    some = F.greatest(n, F.lit(1)).cast("double")
    query = F.regexp_extract(u, "^[^?#]*[?]([^#]*)", 1)
    text = F.concat("host", "path")
    size = F.greatest(F.char_length(text), F.lit(1)).cast("double")
    df = df.withColumn("_letters", F.split(text, ""))
    share = F.transform(F.array_distinct("_letters"),
                        lambda c: (F.size("_letters") - F.size(F.array_remove("_letters", c))) / size)
    entropy = F.aggregate(share, F.lit(0.0), lambda s, p: s - p * F.log2(p))
    return df.select(
        "*", n.cast("double").alias("f_length"), F.char_length("host").cast("double").alias("f_host_length"),
        F.char_length("path").cast("double").alias("f_path_length"),
        F.size(F.filter(F.split("path", "/", -1), lambda s: s != "")).cast("double").alias("f_depth"),
        F.size(F.split("host", "[.]", -1)).cast("double").alias("f_labels"),
        (F.regexp_count(u, F.lit("[0-9]")) / some).alias("f_digits"),
        F.regexp_count(u, F.lit("[-_]")).cast("double").alias("f_hyphens"),
        entropy.alias("f_entropy"),
        F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&", -1)).cast("double")).alias("f_params"),
        F.char_length(query).cast("double").alias("f_query_length"),
        F.contains(u, F.lit("#")).cast("double").alias("f_fragment"),
        F.startswith(u, F.lit("https:")).cast("double").alias("f_secure"))


def suffixes(host: Column) -> tuple[Column, Column]:
    """The last label of a host and its last two."""
    return F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)


class UrlModel:
    """Fitted trees and the suffix statistics they were fitted with."""

    def __init__(self, trees: GBTClassificationModel | None, rates: DataFrame, prior: float):
        self.trees, self.rates, self.prior = trees, rates, prior

    def score(self, df: DataFrame, url: str = "url") -> DataFrame:
        """``df`` (with host and path) plus ``p_block``. Without training rows of both classes the prior."""
        if self.trees is None:
            return df.withColumn("p_block", F.lit(self.prior))
        cols = df.columns
        feats = with_suffix_rates(with_features(df, url), self.rates, self.prior)
        out = self.trees.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="f_all").transform(feats))
        from pyspark.ml.functions import vector_to_array
        return out.select(*cols, vector_to_array("f_prob")[1].alias("p_block"))


def with_suffix_rates(df: DataFrame, rates: DataFrame, prior: float) -> DataFrame:
    one, two = suffixes(F.col("host"))
    for col, name in ((one, "f_suffix1"), (two, "f_suffix2")):
        r = sized_broadcast(rates.select(F.col("suffix").alias(f"_{name}"), F.col("rate").alias(name)), 64)
        df = (df.withColumn(f"_{name}", col).join(r, f"_{name}", "left").drop(f"_{name}")
              .withColumn(name, F.coalesce(name, F.lit(prior))))
    return df


def train_url_model(labelled: DataFrame, url: str = "url", label: str = "block",
                    max_rows: int = MAX_TRAIN_ROWS, rounds: int = 10, depth: int = 4,
                    min_suffix_rows: int = MIN_SUFFIX_ROWS) -> UrlModel:
    """Fit the trees on ``labelled`` (url, host, path, 0/1 label); rows without a label are left out.

    Suffix statistics cover all labelled rows (smoothed block rate of the last one
    and two labels of the host; suffixes of under ``min_suffix_rows`` rows share the overall rate). The trees are fitted
    on ``max_rows`` rows in expectation, drawn by a hash of the URL, so the draw is the same in every run: a class of
    up to half as many is taken whole, the other fills the rest, and rows weigh what they stand for.
    """
    rows = labelled.where(F.col(label).isNotNull()).select(
        url, "host", "path", F.col(label).cast("double").alias("f_label"))
    n, pos = rows.agg(F.count("*"), F.sum("f_label")).first()
    prior = float(pos or 0) / n if n else 0.0
    one, two = suffixes(F.col("host"))
    rates = (rows.select("f_label", F.explode(F.array_distinct(F.array(one, two))).alias("suffix"))
             .groupBy("suffix").agg(F.count("*").alias("n"), F.sum("f_label").alias("s"))
             .where(F.col("n") >= min_suffix_rows)
             .select("suffix", ((F.col("s") + 2 * prior) / (F.col("n") + 2)).alias("rate")))
    rates = cut_lineage(rates)
    if not n or pos in (0, n):
        return UrlModel(None, rates, prior)
    some = {1: pos, 0: n - pos}
    share = {y: min(1.0, max(max_rows / 2, max_rows - some[1 - y]) / some[y]) for y in some}
    by_class = lambda f: F.when(F.col("f_label") == 1, F.lit(f(share[1]))).otherwise(F.lit(f(share[0])))
    grain = 1 << 52
    drawn = rows.where(F.pmod(F.xxhash64(F.coalesce(F.col(url), F.lit(""))), F.lit(grain)) < by_class(lambda x: int(x * grain)))
    feats = with_suffix_rates(with_features(drawn, url), rates, prior).withColumn("f_weight", by_class(lambda x: 1 / x))
    feats = VectorAssembler(inputCols=list(FEATURES), outputCol="f_all").transform(feats).select("f_label", "f_all", "f_weight")
    trees = GBTClassifier(featuresCol="f_all", labelCol="f_label", predictionCol="f_pred", weightCol="f_weight", maxIter=rounds,
                          maxDepth=depth, maxBins=32, seed=17, cacheNodeIds=False)
    return UrlModel(trees.setProbabilityCol("f_prob").setRawPredictionCol("f_raw").fit(feats), rates, prior)


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame, url: str = "url",
                labelled: DataFrame | None = None, **training) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, p_block`` (columns of these names are replaced).

    ``rules``: (host, path, allow|block). The rule's verdict holds; elsewhere the trees', block
    from 0.5 on. ``labelled`` (url, block 0/1) adds to the URLs that rules decide. Every row
    is kept; a null URL has an empty host and path and is judged like any other.
    """
    if not isinstance(rules, DataFrame):
        rules = pages.sparkSession.createDataFrame(
            [tuple(r) for r in rules], "host string, path string, verdict string")
    own = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "p_block", "rule_verdict")]
    pages = with_host_path(pages.select(*[F.col(f"`{c}`") for c in own]), url)
    found = cut_lineage(match_rules(pages.select("host", "path").distinct(), rules))
    judged = pages.join(found, ["host", "path"], "left")
    known = judged.where(F.col("rule").isNotNull()).select(
        F.col(f"`{url}`").alias("url"), "host", "path", (F.col("rule_verdict") == "block").cast("int").alias("block"))
    if labelled is not None:
        known = known.unionByName(with_host_path(labelled.select("url", "block")))
    model = train_url_model(known, "url", **training)
    scored = model.score(judged, url)
    by_trees = F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce("rule_verdict", by_trees)).drop("rule_verdict")
