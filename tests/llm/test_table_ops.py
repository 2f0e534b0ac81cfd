"""Operators on whole tables, against brute force."""

import itertools
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from quarry.llm import chat, decontaminate, mixing, sharding, url_filter
from quarry.llm.queries import QUERIES, SQL, URL_RULES
from scripts.check_oracle import TABLES, digest
from tests.conftest import SF_SMALL
from tests.llm.test_text_ops import docs


def test_every_operator_is_registered_and_the_rest_does_not_need_them():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    assert digest(QUERIES[key](spark, SF_SMALL).toPandas()) == digest(con.sql(SQL[key]).df())


def shingle_counts(text):
    w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
    return len(w), grams


def leaks(texts, items):
    found = set()
    for d, text in texts.items():
        size, grams = shingle_counts(text or "")
        for i, item in items.items():
            n, mine = shingle_counts(item or "")
            if 0 < n < 5:  # one shingle: just these words, anywhere
                w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
                if any(tuple(w[at:at + n]) == mine[0] for at in range(len(w))):
                    found.add((d, i))
                continue
            for at in range(max(1, size - n + 1) if mine and grams else 0):
                win = grams[at:at + max(n - 4, 1)]
                both = sum(min(win.count(g), mine.count(g)) for g in set(win))
                if both / (len(win) + len(mine) - both) >= 0.8:
                    found.add((d, i))
                    break
    return found


def test_decontamination_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    vocab = [f"w{i}" for i in range(60)]
    say = lambda n: " ".join(rng.choice(vocab, n))
    items = {i: say(int(n)) for i, n in enumerate([5, 12, 30, 60, 120, 30])}
    items |= {6: "two words", 7: "", 8: None, 9: items[2], 10: "Capital of France", 11: "solitary"}
    texts = {}
    for d, (i, edits) in enumerate(itertools.product(range(6), (0, 1, 2, 4, 8))):
        w = items[i].split()
        for at in rng.choice(len(w), min(edits, len(w)), replace=False):
            w[at] = "changed"
        texts[d] = f"{say(40)}. {' '.join(w).upper()}! {say(25)}"
    texts |= {100: say(500), 101: None, 102: "", 103: "Two  words", 104: items[1], 105: "a two words b", 106: items[3][:-9],
              107: f"{say(30)} the capital, of FRANCE is {say(9)} two words.", 108: "of france capital", 109: "solitary", 110: "w1 solitary two"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontaminate.find_leaks(docs(spark, list(texts.values()), list(texts)), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == leaks(texts, items)
    assert len(found) == len({(r.doc_id, r.item_id) for r in found})
    table = docs(spark, list(texts.values()), list(texts))
    kept = decontaminate.remove_leaks(table, bench)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == set(texts) - {d for d, _ in leaks(texts, items)}
    assert decontaminate.find_leaks(docs(spark, []), bench).count() == 0
    assert decontaminate.find_leaks(table, bench.where("false")).count() == 0


def test_decontamination_of_very_long_texts_with_many_hits(spark):
    rng = np.random.default_rng(12)
    item = " ".join(f"q{i}" for i in range(30))
    words = [f"w{x}" for x in rng.integers(0, 5000, 200_000)]
    for at in range(0, 200_000, 400):  # 500 passages of the item
        words[at:at + 30] = item.split()
    bench = spark.createDataFrame([(1, item), (2, "q3 q4 q5")], "item_id long, text string")
    found = decontaminate.find_leaks(docs(spark, [" ".join(words), "none"]), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.n_words, r.similarity) for r in found) == [(0, 1, 0, 30, 1.0), (0, 2, 3, 3, 1.0)]


def test_index_finds_every_fingerprint_within_the_radius(spark):
    rng = np.random.default_rng(4)
    base = int(rng.integers(0, 2**62))
    rows = []
    for k in range(0, 18):
        for _ in range(20):
            flips = sum(1 << int(b) for b in rng.choice(62, k, replace=False))
            rows.append((1, len(rows), base ^ flips))
    index = decontaminate.index_items(spark.createDataFrame([(1, 0, base)], "n int, item long, fp long"), 17)
    from pyspark.sql import functions as F
    looked = spark.createDataFrame(rows, "n int, win long, fp long").select(
        "n", "win", F.explode(F.array(*[F.struct(F.lit(i).alias("block"), v.alias("value"))
                                        for i, v in enumerate(decontaminate._blocks(F.col("fp")))])).alias("p")).select("n", "win", "p.*")
    assert looked.join(index, ["n", "block", "value"]).select("win").distinct().count() == len(rows)


def test_url_rules_match_brute_force_and_trees_learn(spark):
    rng = np.random.default_rng(6)
    urls = [None, "", "no scheme", "http://A.NET", "http://A.NET/", "http://net/x?y#z", "https://fr.Example.net/en/#a://b",
            "http://x.example.com/de/1", "http://example.com/fr/1", "http://org/fr/1", "http://xorg/fr/", "ftp://É.org/fr/é?q", "://"]
    hosts = ["a.net", "b.example.net", "x.example.com", "good.org", "spam.biz"]
    urls += [f"http://{rng.choice(hosts)}/{rng.choice(['de', 'en', 'fr'])}/{rng.integers(99)}" for _ in range(300)]
    pages = spark.createDataFrame([(i % 200, u, "h", "p", "old") for i, u in enumerate(urls)],
                                  "page_id long, url string, Host string, p string, verdict string")
    got = url_filter.filter_urls(pages, URL_RULES).collect()
    assert len(got) == len(urls)

    def judge(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, *(max(fits)[1:] if fits else (None, None))
    for r in got:
        host, path, rule, verdict = judge(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.p_block >= 0.5 else "allow"))
    ruled = [r for r in got if r.rule]
    assert np.mean([(r.p_block >= 0.5) == (judge(r.url)[3] == "block") for r in ruled]) > 0.95
    assert url_filter.filter_urls(pages.where("false"), URL_RULES).count() == 0
    assert url_filter.filter_urls(pages.limit(3), URL_RULES).count() == 3


def test_url_hosts_of_very_many_labels_and_ties_of_rules(spark):
    deep = "a." * 100_000 + "net"
    pages = spark.createDataFrame([(1, f"http://{deep}/x"), (2, "http://b.net/en/x"), (3, "http://c.b.net/en/")], "page_id long, url string")
    # equally long rules of two hosts: the smaller string
    rules = [("b.net", "/en/", "block"), ("net", "/en/x", "allow"), ("net", "/", "block")]
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules).select("page_id", "rule", "verdict").collect()}
    assert got == {1: ("net/", "block"), 2: ("b.net/en/", "block"), 3: ("b.net/en/", "block")}
    rules = [("b.net", "/en", "block"), ("net", "/en/xy", "allow")]
    assert len("b.net/en") < len("net/en/xy")
    long = spark.createDataFrame([(1, "http://b.net/en/xy")], "page_id long, url string")
    assert url_filter.filter_urls(long, rules).first().rule == "net/en/xy"


def test_a_rare_class_is_not_lost_in_the_draws(spark):
    n = 3000
    rows = [(i, f"http://h{i % 7}.org/{'bad/' * 3 if i % 300 == 0 else 'good/'}{i}") for i in range(n)]
    urls = url_filter.with_host_path(spark.createDataFrame(rows, "page_id long, url string")).withColumn(
        "block", (F.col("page_id") % 300 == 0).cast("int"))
    model = url_filter.train_url_model(urls, max_rows=200)
    scored = {r.page_id: r.p_block for r in model.score(urls).collect()}
    assert all((scored[i] >= 0.5) == (i % 300 == 0) for i in range(n))


def test_chat_collapse_matches_brute_force(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "bot", "yes"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "bot", "yes"),
            (4, 0, "user", "hi"), (4, 1, "bot", "yes"), (4, 2, "user", "more"), (5, 0, "user", None), (6, 0, "user", ""),
            (6, 0, "user", ""), (None, 0, None, "x"), (None, None, "a", "y"), (8, 5, "user", "other"), (8, 5, "bot", "other")]
    rows += [(9, i, "user", f"t{i}") for i in range(20)] + [(10, i * 3, "user", f"t{i}") for i in range(19)]
    conv = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, c string, i int")
    for stretch in (256, 4):
        got = chat.collapse_and_render(conv, stretch).collect()
        assert {r.conv_id for r in got} == {4, 5, 6, None, 8, 9}
        whole = {}
        for r in sorted(got, key=lambda r: r.part):
            whole[r.conv_id] = whole.get(r.conv_id, "") + r.rendered
        assert whole[4] == "<|user|>\nhi\n<|end|>\n<|bot|>\nyes\n<|end|>\n<|user|>\nmore\n<|end|>\n"
        assert whole[None] == "<|a|>\ny\n<|end|>\n<|unknown|>\nx\n<|end|>\n"
        assert whole[9] == "".join(f"<|user|>\nt{i}\n<|end|>\n" for i in range(20))
    assert chat.collapse_and_render(conv.where("false")).count() == 0


def test_chat_with_many_turns_without_a_number(spark):
    """One conversation without an id, its turns without numbers, is many stretches; its order is by role and text."""
    turns = [(None, None, "user" if i % 2 else "bot", f"t{i:04d}") for i in range(600)] + [(1, i, "user", f"u{i}") for i in range(300)]
    conv = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = chat.collapse_and_render(conv).collect()
    text = "".join(r.rendered for r in sorted((r for r in got if r.conv_id is None), key=lambda r: r.part))
    want = sorted((r, t) for _, _, r, t in turns[:600])
    assert text == "".join(f"<|{r}|>\n{t}\n<|end|>\n" for r, t in want)
    assert chat.numbered_turns(conv).groupBy("c").agg(F.max("i")).orderBy("c").collect()[0][1] == 599


def test_sharding_law_slots_and_weights(spark):
    texts = ["x" * i for i in range(300)] + [None, "", "é", "é"]
    ids = [*range(300), None, None, 5, 5]
    got = sharding.shard_report(docs(spark, texts, ids)).collect()
    assert len(got) == 304
    by_shard, of = {}, {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
        of.setdefault(r.doc_id, set()).add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert all(len(v) == 1 for v in of.values())
    many = sharding.assign_shards(spark.range(20_000).withColumnRenamed("id", "doc_id"), [1.0, 3.0])
    n = many.groupBy("shard").count().collect()
    assert abs({r["shard"]: r["count"] for r in n}[1] / 20_000 - 0.75) < 0.02
    assert sharding.shard_report(docs(spark, [])).count() == 0
    import zlib

    import xxhash
    facts = {(i, len((x or "").encode()) + 8, zlib.crc32((x or "").encode())) for i, x in zip(ids, texts)}
    assert {(r.doc_id, r["size"], r.text_crc32) for r in got} == facts and {r.law for r in got} == {"key"}

    def winner(key, shards):
        """Equal weights: the largest hash of key and shard number, as Spark chains its XXH64 over the columns."""
        def h(i):
            seed = xxhash.xxh64_intdigest(key.encode(), 42)
            return xxhash.xxh64_intdigest(i.to_bytes(4, "little"), seed) >> 12
        return max(range(shards), key=lambda i: (h(i), -i))
    for r in got:
        key = "null" if r.doc_id is None else f"k{r.doc_id}"
        assert (r.shard, r.grown_shard) == (winner(key, 24), winner(key, 25))
    with pytest.raises(ValueError):
        sharding.assign_shards(spark.range(1), [0.0], "id")


def test_slots_of_null_ids_and_equal_rows_do_not_share_a_range(spark):
    """A third of the rows has no id and one text: no numbering range holds them all, and slots stay gapless."""
    n = 30_000
    rows = spark.range(n).repartition(16).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("doc_id"), F.lit("t").alias("_h"), F.lit(0).alias("shard"))
    got = sharding.number_slots(rows, "shard", ["doc_id", "_h"], ranges=64)
    assert got.columns == ["shard", "doc_id", "_h", "slot"] or set(got.columns) == {"shard", "doc_id", "_h", "slot"}
    assert got.agg(F.min("slot"), F.max("slot"), F.count_distinct("slot")).first()[:] == (0, n - 1, n)
    h = F.xxhash64("doc_id", F.col("doc_id").isNull(), "_h", F.col("_h").isNull(), F.spark_partition_id())
    most = rows.groupBy(F.pmod(F.shiftrightunsigned(h, 20), F.lit(64))).count().agg(F.max("count")).first()[0]
    assert most < n / 10


def test_targets_and_flow():
    sizes = {"a": 10.0, "b": 1000.0, None: 5.0}
    t = mixing.source_targets(sizes)
    assert t["a"] == 30 and t[None] == 15 and t["b"] == 1015 - 45
    # overlapping: the shared pattern serves the source that has nothing else, before anything repeats
    flow = mixing.min_cost_flow({"A": 10, "AB": 10}, {"A": ["a"], "AB": ["a", "b"]}, {"a": 10, "b": 10}, 3)
    assert flow == {("A", "a"): 10, ("AB", "a"): 0, ("AB", "b"): 10}
    flow = mixing.min_cost_flow({"A": 10, "AB": 10}, {"A": ["a"], "AB": ["a", "b"]}, {"a": 25, "b": 12}, 3)
    assert sum(v for (p, s), v in flow.items() if s == "a") == 25 and flow["AB", "b"] == 12
    assert max(flow["A", "a"], flow["AB", "a"] + 12) <= 20  # both used twice at most: costs are convex


def test_flow_is_cheapest_by_exhaustive_search():
    """Three patterns and three sources: no other split of the words costs less repetition."""
    import random
    rng = random.Random(3)

    def cost(used, capacity, repeats):
        return sum(k * max(0, min(used[p] - k * capacity[p], capacity[p])) for p in capacity for k in range(1, repeats))
    for _ in range(60):
        some = rng.sample(["a", "b", "c", "ab", "ac", "bc", "abc"], 3)  # patterns are distinct
        member = {p: list(x) for p, x in enumerate(some)}
        capacity = {p: rng.randint(1, 3) for p in member}
        quota = {s: rng.randint(0, 5) for s in "abc"}
        edges = [(p, s) for p in member for s in member[p]]
        best = None
        for split in itertools.product(*[range(quota[s] + 1) for _, s in edges]):
            used = {p: sum(x for x, (q, _) in zip(split, edges) if q == p) for p in member}
            got = {s: sum(x for x, (_, t) in zip(split, edges) if t == s) for s in quota}
            if all(got[s] <= quota[s] for s in quota) and all(used[p] <= 3 * capacity[p] for p in member):
                best = max(best or (-1, 0), (sum(split), -cost(used, capacity, 3)))
        for solve in (mixing.min_cost_flow, mixing.share_out):
            flow = solve(capacity, member, quota, 3)
            used = {p: sum(v for (q, _), v in flow.items() if q == p) for p in member}
            assert all(sum(v for (_, t), v in flow.items() if t == s) <= quota[s] + 1e-6 for s in quota)
            assert abs(sum(flow.values()) - best[0]) < 1e-6 and abs(cost(used, capacity, 3) + best[1]) < 1e-6


def test_many_single_sources_need_no_search():
    import time
    n = 50_000
    start = time.time()
    flow = mixing.share_out({i: 10.0 + i for i in range(n)}, {i: [i] for i in range(n)}, {i: 15.0 + i for i in range(n)})
    assert time.time() - start < 10 and flow[7, 7] == 22.0 and len(flow) == n


def test_mix_of_equal_rows_gives_what_the_mix_took(spark):
    words = " ".join(["w"] * 25)
    for left in (600, 550, 425, 1000):
        rows = [("s", None, words)] * 40
        table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "source string, doc_id long, text string, _rows int, _copies int, _each int")
        target = lambda sizes: {"s": float(left)}
        keep, mixing.source_targets = mixing.source_targets, target
        try:
            out = mixing.mix_documents(table.repartition(5))
            assert out.columns == table.columns and out.count() * 25 == left
        finally:
            mixing.source_targets = keep


def test_mix_takes_one_document_more_where_that_is_nearer(spark):
    rows = [("a", 1, 100), ("a", 2, 100), ("b", 1, 100), ("b", 2, 100), ("c", 1, 10), ("c", 2, 100)]
    table = spark.createDataFrame(rows, "source string, doc_id long, size long")
    aim = {"a": 175.0, "b": 130.0, "c": 10.0}
    got = mixing.mix(table, F.array("source"), F.col("size"), lambda _: aim, [F.col("source"), F.col("doc_id")]).collect()
    taken = {s: sum(r["size"] * r._copies for r in got if r.source == s) for s in aim}
    assert taken == {"a": 200, "b": 100, "c": 10}


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 200))) if i % 50 else None, f"s{min(i % 9, 4)}" if i % 7 else None)
            for i in range(900)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, _size int")
    got = mixing.mix_report(table.select("doc_id", "text", "source")).collect()
    size = {i: len((x or "").split()) for i, x, _ in rows}
    source = {i: s for i, _, s in rows}
    total = {}
    for i, n in size.items():
        total[source[i]] = total.get(source[i], 0) + n
    aim, taken = mixing.source_targets({s: float(n) for s, n in total.items()}), {}
    for r in got:
        assert (r["size"], r.source_size, r.target) == (size[r.doc_id], total[source[r.doc_id]], aim[source[r.doc_id]])
        assert r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    assert all(abs(taken[s] - aim[s]) <= max(3, 0.01 * aim[s]) for s in aim)
    again = mixing.mix_report(table.select("doc_id", "text", "source").repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix_report(docs(spark, [])).count() == 0
    mixed = mixing.mix_documents(docs(spark, [x for _, x, _ in rows]))
    assert mixed.columns == docs(spark, []).columns
    assert mixing.mix_documents(docs(spark, [None, ""])).count() >= 0


def test_pipeline_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    source = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert out.columns == [*source.columns, "shard"]
    texts = {r.doc_id: r.text for r in source.collect()}
    rows = out.collect()
    assert 0 < len(rows) and all(texts[r.doc_id] == r.text for r in rows)
    bench = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert any(b in t for b in bench for t in texts.values())
    assert not any(b in r.text for b in bench for r in rows)
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_mix_goes_on_after_a_document_that_does_not_fit(spark):
    rng = np.random.default_rng(9)
    # one long document among many; every source has its own seeded order
    sizes = {f"s{s}": [10_000, *(int(n) for n in rng.integers(30, 70, 300))] for s in range(12)}
    sizes["equal"] = [700] * 40
    rows = [(s, 0 if s == "equal" else i, n) for s, some in sizes.items() for i, n in enumerate(some)]
    table = spark.createDataFrame(rows, "source string, doc_id long, size long")
    aim = {s: 15_000.0 for s in sizes}
    got = mixing.mix(table, F.array("source"), F.col("size"), lambda _: aim, [F.col("source"), F.col("doc_id")]).collect()
    assert len(got) == len(rows) and {r._copies for r in got} == {0, 1}
    for s in sizes:
        taken = sum(r["size"] for r in got if r.source == s and r._copies)
        # nearer than by leaving out or adding any document of those left
        assert 2 * abs(15_000 - taken) <= min(r["size"] for r in got if r.source == s and not r._copies) + 1


def test_decontamination_tells_rows_of_one_id_apart_by_text(spark):
    item = " ".join(f"q{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    texts = [f"before {item} after", "clean text of a row without an id", "another clean one", f"{item} twice", None, item, "clean, of an id that leaks too"]
    table = docs(spark, texts, [None, None, None, None, None, 7, 7])
    assert sorted(r.text or "" for r in decontaminate.remove_leaks(table, bench).collect()) == sorted(
        ["", texts[1], texts[2], texts[6]])
    found = decontaminate.find_leaks(table, bench).collect()
    assert sorted((r.doc_id or 0, r.start, r.n_words) for r in found) == [(0, 0, 20), (0, 1, 20), (7, 0, 20)]
