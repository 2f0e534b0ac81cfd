"""Operators on single texts and on lines, against brute force."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash

from quarry.llm import line_dedup, merkle, simhash_dedup, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, t long, k string, drop string"


def docs(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, x, "en", "s", 0, 1, "k", "d") for i, x in zip(ids, texts)], SCHEMA)


def test_line_dedup_matches_brute_force(spark):
    long = "A Line of more than forty code points, sométhing shared"
    texts = ["", None, "a\n\nb\n", f"x\n  {long}\t\n{long.replace('A', 'a')}", long, long.replace("L", "l") + " ", f"{long}\nq",
             f"{long}\n{long}", "y\n" * 3, "z" * 60]
    got = {r[0]: tuple(r[1:]) for r in line_dedup.dedup_lines(docs(spark, texts)).collect()}
    blanks, lower = " \t\n\x0b\x0c\r", str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    holders = {}
    for i, x in enumerate(texts):
        for line in (x or "").split("\n"):
            holders.setdefault(line.strip(blanks).translate(lower), set()).add(i)
    for i, x in enumerate(texts):
        lines = (x or "").split("\n")
        keys = [line.strip(blanks).translate(lower) for line in lines]
        gone = [len(c) >= 40 and len(holders[c]) >= 5 and max(holders[c]) != i for c in keys]
        assert got[i] == (len(lines), sum(gone), "\n".join(line for line, g in zip(lines, gone) if not g))
    assert sum(v[1] for v in got.values()) == 5


def test_line_dedup_empty_table_repeated_rows_and_null_ids(spark):
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0
    line = "w" * 50
    got = line_dedup.dedup_lines(docs(spark, [line] * 9, [1, 1, 1, 2, 3, 4, None, None, 4])).collect()
    # five distinct ids (null is one): all but the largest lose the line, rows that repeat it keep theirs
    assert sorted((-1 if r[0] is None else r[0], r[2]) for r in got) == [
        (-1, 1), (-1, 1), (1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 0), (4, 0)]


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    words = ["Wort", "é", "the", "of", "X", "lang", "\u2003", "zwei"]
    texts = [None, "", " \t", "one", "One two", "one two three"]
    for _ in range(60):
        w = list(rng.choice(words, rng.integers(1, 200)))
        texts += [" ".join(w), "\n".join([*w, "end"]), " ".join([w[0].upper(), *w[1:]])]
    texts.append(" ".join(f"w{i}" for i in range(150_000)))
    ids = [i * 7 % 1009 for i in range(len(texts))]
    prints = [simhash(x) for x in texts]
    label = {i: i for i in range(len(texts))}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = root(i), root(j)
                label[max(a, b, key=lambda q: ids[q])] = min(a, b, key=lambda q: ids[q])
    want = {ids[i]: (f"{prints[i]:016x}", ids[root(i)]) for i in range(len(texts))}
    for chunk in (8192, 4):
        got = {r[0]: tuple(r[1:]) for r in simhash_dedup.near_duplicates(docs(spark, texts, ids), chunk=chunk).collect()}
        assert got == want


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_bit_sliced_links_span_what_popcount_finds(radius):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = centres[rng.integers(0, 40, 700)]
    for _ in range(3):
        values = values ^ (np.uint64(1) << rng.integers(0, 64, 700).astype(np.uint64))
    keys = np.sort(rng.integers(0, 9, 700))
    rows, to = simhash_dedup.spanning_links(keys, values, radius)
    parent = np.arange(700)
    parent[rows] = to
    close = (np.bitwise_count(values[:, None] ^ values[None, :]) <= radius) & (keys[:, None] == keys[None, :])
    seen = np.full(700, -1)
    for i in range(700):
        if seen[i] < 0:
            todo = [i]
            while todo:
                j = todo.pop()
                if seen[j] < 0:
                    seen[j] = i
                    todo += np.flatnonzero(close[j] & (seen < 0)).tolist()
    assert (parent == seen).all()


def test_keep_one_keeps_columns_of_any_name(spark):
    table = docs(spark, ["a b c", "a b c", "d e f"], [2, 1, 1]).withColumnsRenamed({"k": "_k", "t": "_n", "drop": "_h"})
    kept = simhash_dedup.keep_one(table.unionByName(table))
    assert kept.columns == table.columns and sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "a b c"), (1, "d e f")]
    none = docs(spark, [])
    assert simhash_dedup.near_duplicates(none).count() == 0
    some = simhash_dedup.near_duplicates(docs(spark, ["x", "x", "y z w q"], [None, 3, 3])).collect()
    assert sorted(str(r.component_id) for r in some) == ["3", "None", "None"]


def test_keep_one_keeps_columns_and_one_row(spark):
    same = "some words that are here more than once in the table"
    table = docs(spark, [same, same, "other words altogether, not like the first", same, None, ""], [5, 3, 9, 3, None, 2])
    kept = simhash_dedup.keep_one(table)
    assert kept.columns == table.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "9", "None"]
    assert simhash_dedup.keep_one(docs(spark, [])).count() == 0


def test_keep_one_is_by_row_with_null_and_repeated_ids(spark):
    say = lambda c: " ".join(f"{c}{i}" for i in range(30))
    rows = [(None, say("a")), (None, say("b")), (None, say("c")), (4, say("c")), (4, say("d")), (5, say("c")), (6, say("d")),
            (7, say("e")), (7, say("f")), (8, say("f")), (9, say("g")), (9, say("g")), (3, say("e"))]
    kept = simhash_dedup.keep_one(docs(spark, [x for _, x in rows], [i for i, _ in rows])).collect()
    assert sorted((r.doc_id or 0, r.text[0]) for r in kept) == [(0, "a"), (0, "b"), (0, "c"), (3, "e"), (4, "d"), (7, "f"), (9, "g")]
    # rows that differ only in where a null is are two rows of one group
    table = docs(spark, [say("a")] * 2, [1, 1]).selectExpr("doc_id", "text", "if(rand(1) < 2, null, lang) AS lang", "source")
    table = table.limit(1).unionByName(table.limit(1).selectExpr("doc_id", "text", "source AS lang", "lang AS source"))
    assert simhash_dedup.keep_one(table).count() == 1


def test_merkle_equality_edit_place_and_edges(spark):
    texts = ["a. b\nc", "a. b\nc", "a. b\nd", "", None, "x" * 300_000, "p\n" * 20_000]
    rows = {r.doc_id: r for r in merkle.fingerprint_documents(docs(spark, texts)).collect()}
    assert rows[0].fingerprint == rows[1].fingerprint != rows[2].fingerprint
    assert rows[3].fingerprint == rows[4].fingerprint
    assert len({r.fingerprint for r in rows.values()}) == 5
    report = {r.doc_id: r for r in merkle.edit_report(docs(spark, texts)).collect()}
    full = [x or "" for x in texts]
    for i, x in enumerate(full):
        half = len(x) // 2
        edited = x[:len(x) - half] + full[(i + 1) % len(full)][:half]
        assert report[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (report[i].near_edited == 1) == (edited == x)
        assert 0 <= report[i].near_next <= 1
    assert report[0].near_next == 1 and report[2].first_change == 0 and report[6].first_change == 10_000


def test_edits_are_located_by_sections(spark):
    """An inserted and a changed paragraph are the two that are new; what only moved is no change."""
    lines = [f"paragraph number {i}. It says {i * i}." for i in range(400)]
    edited = lines[:100] + ["put in here"] + lines[100:250] + ["changed"] + lines[251:]
    pairs = [("\n".join(lines), "\n".join(edited)), ("same\ntext", "same\ntext"), (None, "a\nb"), ("", None), ("x", "y\nx\nz\nw")]
    df = spark.createDataFrame([(i, a, b, "c") for i, (a, b) in enumerate(pairs)], "doc_id long, text string, other string, _x string")
    got = {r.doc_id: r for r in merkle.locate_edits(df, "text", "other").collect()}
    flat = lambda spans: [tuple(s) for s in spans]
    assert flat(got[0].added) == [(100, 100), (251, 251)] and flat(got[0].removed) == [(250, 250)]
    assert got[1].fingerprint_before == got[1].fingerprint_after and not got[1].added and not got[1].removed
    assert flat(got[2].added) == [(0, 1)] and flat(got[2].removed) == [(0, 0)]
    assert not got[3].added and got[4]._x == "c"
    assert flat(got[4].added) == [(0, 0), (2, 3)] and not got[4].removed


def test_neighbours_of_a_hot_id(spark):
    """A third of the rows has no id: its rows are many ranges, and the order is that of all rows."""
    from quarry.llm.common import NO_ID
    rng = np.random.default_rng(13)
    rows = [(NO_ID if i % 3 == 0 else i, int(t), i) for i, t in enumerate(rng.integers(-2**63, 2**63 - 1, 3000))]
    df = spark.createDataFrame(rows, "k long, t long, n long")
    want = sorted(rows)
    got = {(r.k, r.t): tuple(r)[2:] for r in merkle.neighbours(df, 16).collect()}
    for i, (k, t, _) in enumerate(want):
        nxt, prv = want[(i + 1) % len(want)], want[i - 1]
        assert got[k, t] == (nxt[0], nxt[1], *prv)


def test_merkle_single_empty_and_repeated_rows(spark):
    assert merkle.edit_report(docs(spark, [])).count() == 0
    one = merkle.edit_report(docs(spark, ["abcd"], [None])).collect()
    assert len(one) == 1 and one[0].doc_id is None
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    again = merkle.edit_report(docs(spark, ["ab", "ab", "cd"], [1, 1, 2])).collect()
    assert sorted(r.edited_sha256 for r in again) == sorted(
        [hashlib.sha256(b"ac").hexdigest()] * 2 + [hashlib.sha256(b"ca").hexdigest()])


PIECES = {"▁": -1.0, "▁a": -2.0, "a": -1.5, "b": -2.5, "ab": -3.0, "▁ab": -4.75, "bb": -3.25, "abab": -5.0}


def brute_tokens(word, pieces):
    path = "▁" + word
    byte = min(pieces.values()) - token_counts.BYTE_PENALTY

    def best(end):
        if end == 0:
            return 0.0, 0
        found = []
        for start in range(end):
            if path[start:end] in pieces:
                s, c = best(start)
                found.append((-(s + pieces[path[start:end]]), c + 1))
        if path[end - 1] not in pieces:
            s, c = best(end - 1)
            cost = len(path[end - 1].encode())
            found.append((-(s + cost * byte), c + cost))
        s, c = min(found)
        return -s, c
    return best(len(path))[1]


def test_token_counts_match_brute_force(spark):
    texts = [None, "", " \n", "ab abab bb a", "abbab zé ab", "aababb  b\tab", "b" * 5000, "a\u2003b ab"]
    table = docs(spark, texts)
    got = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in token_counts.count_tokens(table, pieces=PIECES).collect()}
    for i, x in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", x or "")
        assert got[i][0] == len(words)
        if len(x or "") < 100:
            assert got[i][1] == sum(brute_tokens(w, PIECES) for w in words)
    assert token_counts.count_tokens(docs(spark, []), pieces=PIECES).count() == 0
    assert set(table.columns) < set(token_counts.count_tokens(table, pieces=PIECES).columns)


def test_toxicity_held_out_accuracy_and_edges(spark):
    rng = np.random.default_rng(2)
    plain = ["river", "stone", "cloud", "walking", "green", "table", "morning"]
    bad = ["vilfoo", "vilbar", "vilbaz"]
    texts, labels = [], []
    for i in range(400):
        w = list(rng.choice(plain, 30))
        y = int(i % 4 == 0)
        if y:
            w[int(rng.integers(30))] = str(rng.choice(bad))
        texts.append(" ".join(w))
        labels.append((i, y))
    texts += ["", None, "vilqux " * 3, "river " * 200_000]
    labels += [(None, 1), (7, None), (9999, 1)]
    table = docs(spark, texts)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity_report(table, marks).collect()}
    assert len(got) == len(texts)
    truth = dict(labels[:400])
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in held) for i in range(400))
    assert np.mean([got[i].predicted == truth[i] for i in held]) >= 0.95
    assert got[400].score == got[401].score < 0.5 and got[403].predicted == 0
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert toxicity.toxicity_report(docs(spark, []), marks).count() == 0
    none = toxicity.toxicity_report(table, marks.where("false")).collect()
    assert len(none) == len(texts) and all(r.predicted == 0 for r in none)
    assert toxicity.drop_toxic(table, marks).columns == table.columns


def test_a_rare_toxic_class_is_not_lost_in_the_draw(spark):
    rng = np.random.default_rng(7)
    plain = ["river", "stone", "cloud", "walking", "green", "table", "morning"]
    texts = [" ".join(rng.choice(plain, 12)) + (" vilfoo" if i % 600 == 1 else "") for i in range(3000)]
    marks = spark.createDataFrame([(i, int(i % 600 == 1)) for i in range(3000)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs(spark, texts), marks, max_rows=150)
    scores = [model.score(t) for t in texts]
    assert min(s for i, s in enumerate(scores) if i % 600 == 1) > 0.5 > max(s for i, s in enumerate(scores) if i % 600 != 1)
    table = docs(spark, texts[:20]).withColumnRenamed("k", "_toxic")
    kept = toxicity.drop_toxic(table, marks)
    assert kept.columns == table.columns and {r["_toxic"] for r in kept.collect()} == {"k"}


def test_toxicity_score_equals_the_sum_over_the_gram_set():
    rng = np.random.default_rng(3)
    text = "Some Text with a few wörds, and some of them twice: some text"
    grams = toxicity.gram_set(text)
    other = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    hashes = np.unique(np.concatenate((grams[::2], grams[::2] + np.uint64(1), other)))
    model = toxicity.ToxicityModel(hashes, rng.normal(size=len(hashes)), 0.25)
    total = 0.25 + model.weights[np.isin(hashes, grams)].sum()
    assert math.isclose(model.score(text), 1 / (1 + math.exp(-total)))


def test_components_of_few_edges_are_not_dealt_out(spark):
    """A small edge table takes one partition a round, whatever the number of shuffle partitions; the result is that of a large one."""
    from quarry.llm.common import components
    edges = [(i, i + 1) for i in range(0, 60) if i % 7] + [(100, 3), (3, 100), (100, 200), (5, 5), (200, 40)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    want = {(x, find(x)) for x in parent if find(x) != x}
    keys = {"spark.sql.shuffle.partitions": "9", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = spark.createDataFrame(edges, "u long, v long")
        small, dealt = components(df), components(df, few=0)
        assert {tuple(r) for r in small.collect()} == want == {tuple(r) for r in dealt.collect()}
        assert len(small.inputFiles()) == 1 < len(dealt.inputFiles())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
