"""Corpus build: flattening, chunkers, ids, tokens, embeddings, guards."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.functions.vectors import l2_normalize
from quarry.operators import corpus, embed, filters
from quarry.operators.corpus import ARTICLE_SCHEMA, sentence_chunks, window_chunks
from quarry.sources import store

LONG = " ".join(f"w{i}" for i in range(130)) + "."


def articles(spark):
    sub = lambda n, a, t: {"subsection": n, "subsection_anchor": a, "text": t}
    rows = [{
        "product": "p1", "category": "Disputes", "article_id": "a1", "article_title": "A1", "article_path": "/a1",
        "sections": [
            {"section": "text only", "section_anchor": "#1", "text": "One.\n\nTwo paragraphs.", "subsections": None},
            {"section": "subs only", "section_anchor": "#2", "text": None,
             "subsections": [sub("s1", "#s1", "Sub one."), sub("s2", None, "")]},
            {"section": "both", "section_anchor": "#3", "text": LONG, "subsections": [sub("s3", "#s3", "x")]},
            {"section": "neither", "section_anchor": "#4", "text": "", "subsections": []},
        ]}]
    return spark.createDataFrame(rows, ARTICLE_SCHEMA)


def test_flatten_articles_rules(spark):
    docs = corpus.flatten_articles(articles(spark)).collect()
    key = lambda x: tuple("" if v is None else v for v in x)
    got = sorted(((d["section"], d["subsection"], d["text"]) for d in docs), key=key)
    assert got == sorted([
        ("text only", None, "One.\n\nTwo paragraphs."),
        ("subs only", "s1", "Sub one."), ("subs only", "s2", ""),
        ("both", None, LONG), ("both", "s3", "x")], key=key)
    sub2 = [d for d in docs if d["subsection"] == "s2"][0]
    assert sub2["subsection_anchor"] is None and sub2["product"] == "p1"


def test_read_articles_json(spark, tmp_path):
    articles(spark).write.json(str(tmp_path / "a"))
    assert store.read_articles(spark, str(tmp_path / "a")).count() == 1


@pytest.mark.parametrize("seed", range(5))
def test_sentence_chunker_properties(seed):
    rng = random.Random(seed)
    sents = []
    for _ in range(rng.randint(1, 40)):
        n = rng.choice([3, 8, 20, 60, 140])
        words = [f"t{rng.randint(0, 999)}" for _ in range(n)]
        if n > 100:
            for j in range(0, n, rng.randint(5, 30)):
                words[j] += ","
        sents.append(" ".join(words) + rng.choice([".", "!", "?"]))
    text = " ".join(sents)
    if seed % 2:
        text = text.replace("! ", "!\n\n")
    chunks = sentence_chunks(text, 100, 30)
    words = text.split()
    assert all(len(c.split()) <= 100 for c in chunks)
    # every word covered, in order (chunks overlap by at most 30 words)
    pos = 0
    for c in chunks:
        cw = c.split()
        # find the chunk start inside the last 30 words before pos
        start = None
        for s in range(max(0, pos - 30), pos + 1):
            if words[s:s + len(cw)] == cw:
                start = s
                break
        assert start is not None
        assert pos - start <= 30
        assert start + len(cw) > pos  # advances by at least one new word
        pos = start + len(cw)
    assert pos == len(words)


def test_sentence_chunks_are_stretches_of_the_text():
    long = " ".join(f"pi{i} is 3.14, wait;\nmore{i}" for i in range(60)) + "."
    text = f"First line.\n\nSecond\tline!  {long} Last one"
    chunks = sentence_chunks(text, 100, 30)
    at = covered = 0
    for c in chunks:
        at = text.index(c, at)
        assert not text[covered:at].strip() and len(c.split()) <= 100
        covered = at + len(c)
    assert covered == len(text) and len(chunks) > 1
    assert sentence_chunks("", 100, 30) == [] and sentence_chunks(None) == [] and sentence_chunks(" \n\n ") == []


def test_window_chunker():
    w = [str(i) for i in range(250)]
    ch = window_chunks(w, 100, 70)
    assert [len(c.split()) for c in ch] == [100, 100, 100, 40]
    assert ch[-1].split()[-1] == "249"
    assert window_chunks([], 100, 70) == []


def test_chunk_ids_and_columns(spark):
    docs = corpus.flatten_articles(articles(spark)).withColumn("doc_id", F.monotonically_increasing_id())
    ch = corpus.with_node_columns(corpus.chunk(docs), "m")
    rows = ch.collect()
    assert all(r["node_id"] == r["doc_id"] * (1 << 20) + r["chunk_no"] for r in rows)
    assert all(r["deleted"] is False and r["embedding_model"] == "m" for r in rows)
    assert max(len(r["text"].split()) for r in rows) <= 100
    corpus.check_metadata(ch, docs)


def test_tokens_words_and_punctuation(spark):
    df = spark.createDataFrame([("Hello, world! Ça va?",)], "text string")
    from quarry.functions.text import tokens
    assert df.select(tokens("text")).first()[0] == ["Hello", ",", "world", "!", "Ça", "va", "?"]


def test_strict_normalize_rejects_zero_vector(spark):
    df = spark.createDataFrame([([0.0, 0.0],)], "v array<float>")
    with pytest.raises(Exception, match="norm 0"):
        df.select(l2_normalize("v")).collect()
    assert df.select(l2_normalize("v", strict=False)).first()[0] == [0.0, 0.0]


def test_validate_embeddings_errors(spark):
    ok = spark.createDataFrame([(1, [1.0, 0.0])], "node_id long, embedding array<float>")
    embed.validate_embeddings(ok, 2)
    bad_null = spark.createDataFrame([(1, [1.0, 0.0]), (7, None)], "node_id long, embedding array<float>")
    with pytest.raises(ValueError, match="null at id 7"):
        embed.validate_embeddings(bad_null, 2)
    bad_dim = spark.createDataFrame([(3, [1.0, 0.0, 0.0])], "node_id long, embedding array<float>")
    with pytest.raises(ValueError, match="length is not 2 at id 3"):
        embed.validate_embeddings(bad_dim, 2)


def test_active_guards(spark):
    df = spark.createDataFrame([(1, None), (2, True), (3, False)], "node_id long, deleted boolean")
    assert sorted(r[0] for r in filters.active(df, check=True).collect()) == [1, 3]
    with pytest.raises(ValueError, match="table is empty"):
        filters.active(df.limit(0), check=True)
    with pytest.raises(ValueError, match="marked deleted"):
        filters.active(df.where("node_id = 2"), check=True)


def test_chunk_store_roundtrip_and_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "node_id long, text string")
    store.write_chunks(df, str(tmp_path / "c"))
    assert store.read_chunks(spark, str(tmp_path / "c")).count() == 1
    store.write_chunks(df.limit(0), str(tmp_path / "e"))
    with pytest.raises(ValueError, match="no chunk rows"):
        store.read_chunks(spark, str(tmp_path / "e"))
    with pytest.raises(ValueError, match="no chunk table"):
        store.read_chunks(spark, str(tmp_path / "missing"))


def test_hashed_embedding_unit_length(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "!!!")], "node_id long, text string")
    rows = embed.hashed_embedding(df, "text", 16).collect()
    assert [r[0] for r in rows] == [1]
    assert abs(sum(x * x for x in rows[0][1]) - 1.0) < 1e-5


def test_hashed_embedding_row_local_equals_sql_form(spark):
    from tests.conftest import SF_SMALL
    from quarry.plans.catalog import doc_nodes
    d = doc_nodes(spark, SF_SMALL).select("node_id", "text")
    a = {r[0]: r[1] for r in embed.hashed_embedding(d, "text", 64).collect()}
    b = {r[0]: r[1] for r in embed.hashed_embedding_sql(d, "text", 64).collect()}
    assert a.keys() == b.keys() and len(a) > 100
    assert all(max(abs(x - y) for x, y in zip(a[k], b[k])) < 1e-7 for k in a)


def test_hashed_embedding_keep_columns(spark):
    df = spark.createDataFrame([(1, "a b c", "x"), (2, "!!!", "y"), (3, "c b a", "z")], "node_id long, text string, m string")
    rows = {r["node_id"]: r for r in embed.hashed_embedding(df, "text", 16, keep_columns=True).collect()}
    plain = {r[0]: r[1] for r in embed.hashed_embedding(df, "text", 16).collect()}
    assert rows[2]["embedding"] is None and rows[2]["m"] == "y"
    assert rows[1]["embedding"] == plain[1] and rows[3]["embedding"] == plain[3]


def test_normalise_matches_numpy_and_blanks_are_no_tokens(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from quarry.functions.text import tokens
    from quarry.functions.vectors import l2_normalize
    v = [3.0, -4.0, 12.0]
    df = spark.createDataFrame([(v,), ([0.0, 0.0],), (None,)], "v array<float>")
    got = [r[0] for r in df.select(l2_normalize("v", strict=False)).collect()]
    assert np.allclose(got[0], np.array(v) / 13) and got[1] == [0.0, 0.0] and got[2] is None
    text = spark.createDataFrame([("a\u2003b\u202f. c\x1cd",)], "text string")
    assert text.select(tokens("text")).first()[0] == ["a", "b", ".", "c", "d"]


def test_document_ids_tell_sections_apart_by_anchor(spark):
    rows = [("a", "Title", "one", None, None), ("a", "Title", "two", None, None)]
    df = spark.createDataFrame(rows, "article_id string, section string, section_anchor string, subsection string, subsection_anchor string")
    assert corpus.with_doc_id(df).select("doc_id").distinct().count() == 2


def test_hashed_document_ids_chunk_without_overflow(spark):
    rows = [(f"a{i}", "s", None, None, None, "one two three. " * 40) for i in range(20)]
    df = spark.createDataFrame(rows, "article_id string, section string, section_anchor string, subsection string, "
                                     "subsection_anchor string, text string")
    got = corpus.chunk(corpus.with_doc_id(df), size=20, overlap=5, layout="hash")
    assert got.count() > 40 and got.select("node_id").distinct().count() == got.count()
    with pytest.raises(ValueError, match="layout"):
        corpus.chunk(corpus.with_doc_id(df), layout="other")


def test_embedding_models_run_as_plug_ins(spark):
    """The stand-in row by row, and another model in batches, loaded before its first batch."""
    import numpy as np

    from quarry.operators import embed as emb
    from quarry.plugins import Embedder, HashedEmbedder
    df = spark.createDataFrame([(1, "two words", 7, "x"), (2, "", 8, "y"), (3, None, 9, "z")], "node_id long, text string, t long, id string")
    got = {r.node_id: r for r in emb.embed(df, model=HashedEmbedder(16), out_col="vec").collect()}
    want = HashedEmbedder(16).encode(["two words"])[0]
    assert np.allclose(got[1].vec, want) and got[2].vec is None and got[3].vec is None and (got[3].t, got[3].id) == (9, "z")

    class Lengths(Embedder):
        dim, ready = 2, False

        def load(self):
            self.ready = True

        def encode(self, texts):
            assert self.ready
            return np.array([[len(t), len(t.split())] for t in texts], np.float32)
    other = {r.node_id: list(r.embedding) for r in emb.embed(df, model=Lengths()).collect()}
    assert other == {1: [9.0, 2.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}


def test_scorers_run_as_plug_ins(spark):
    from quarry.operators import rerank
    from quarry.plugins import PairScorer

    class Shorter(PairScorer):
        def load(self):
            self.sign = -1.0

        def score(self, queries, texts):
            import numpy as np
            return np.array([self.sign * len(t) for t in texts])
    c = spark.createDataFrame([(1, 1, 1, "long text here", "q"), (1, 2, 2, "short", "q"), (1, 3, 3, "mid text", "q")],
                              "query_id long, node_id long, rank long, text string, query_text string")
    got = [(r.node_id, r["rank"]) for r in rerank.rerank(c, Shorter(), 2).orderBy("rank").collect()]
    assert got == [(2, 1), (3, 2)]


def test_signed_counts_hold_no_object_per_term():
    """Equal terms become one Python object, whatever the length of the batch; rows may be null or empty."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from quarry.operators import embed
    from quarry.plugins import HashedEmbedder
    lists = [None, [], *[[f"wörd{(i * j) % 50}" for j in range(300)] for i in range(1000)]]
    arr = pa.array(lists, pa.list_(pa.string()))
    tracemalloc.start()
    got = embed.signed_counts(arr, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16_000_000  # numbers of 300,000 terms; as objects they take over 18 MB more
    norm = np.linalg.norm(got, axis=1, keepdims=True)
    unit = np.where(norm > 0, got / np.where(norm > 0, norm, 1), 0)
    want = HashedEmbedder(16).encode([" ".join(x or []) for x in lists])
    assert np.allclose(unit, want, atol=1e-6)
    assert embed.signed_counts(pa.array([None, []], pa.list_(pa.string())), 4).tolist() == [[0.0] * 4] * 2
