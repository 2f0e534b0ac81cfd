"""Nested corpus flattening, chunking, ids and tokens.

Everything is narrow (no shuffle): explode + union for the nested corpus,
an Arrow-batched pandas UDF for the chunkers (packing is sequential inside
one text, parallel across texts), and built-in expressions for the rest.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import tokens as token_col
from ._plan import gen_rows

# Chunker settings of the reference.
CHUNK_SIZE = 100
CHUNK_OVERLAP = 30
PARAGRAPH_SEP = "\n\n"
CLAUSE_ENDS = ",.;。？！"
SENTENCE_END_RE = r"(?<=[.!?。？！])\s+"
# Chunk ids: doc_id * 2^20 + chunk_no.
CHUNK_BITS = 20

ARTICLE_SCHEMA = T.StructType([
    T.StructField("product", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("article_id", T.StringType()),
    T.StructField("article_title", T.StringType()),
    T.StructField("article_path", T.StringType()),
    T.StructField("sections", T.ArrayType(T.StructType([
        T.StructField("section", T.StringType()),
        T.StructField("section_anchor", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("subsections", T.ArrayType(T.StructType([
            T.StructField("subsection", T.StringType()),
            T.StructField("subsection_anchor", T.StringType()),
            T.StructField("text", T.StringType()),
        ]))),
    ]))),
])

ARTICLE_COLS = ["product", "category", "article_id", "article_title", "article_path"]
DOC_META = ARTICLE_COLS + ["section", "section_anchor", "subsection", "subsection_anchor"]


def flatten_articles(articles: DataFrame) -> DataFrame:
    """B1 / B2: one document per section with non-empty text (subsection
    fields null) plus one per subsection, always, even with empty text."""
    sec = articles.select(*ARTICLE_COLS, F.explode("sections").alias("s"))
    own = sec.where(F.length(F.col("s.text")) > 0).select(
        *ARTICLE_COLS, F.col("s.section").alias("section"),
        F.col("s.section_anchor").alias("section_anchor"),
        F.lit(None).cast("string").alias("subsection"),
        F.lit(None).cast("string").alias("subsection_anchor"),
        F.col("s.text").alias("text"))
    subs = sec.select(*ARTICLE_COLS, F.col("s.section").alias("section"),
                      F.col("s.section_anchor").alias("section_anchor"),
                      F.explode(F.coalesce(F.col("s.subsections"),
                                           F.array().cast(ARTICLE_SCHEMA["sections"].dataType
                                                          .elementType["subsections"].dataType)))
                      .alias("u"))
    subs = subs.select(*ARTICLE_COLS, "section", "section_anchor",
                       F.col("u.subsection").alias("subsection"),
                       F.col("u.subsection_anchor").alias("subsection_anchor"),
                       F.col("u.text").alias("text"))
    return own.unionByName(subs)


def with_doc_id(docs: DataFrame) -> DataFrame:
    """Deterministic document id: xxhash64 of the identifying metadata."""
    return docs.withColumn("doc_id", F.xxhash64(*[F.coalesce(F.col(c), F.lit("\u0000")) for c in
                                                   ["article_id", "section", "section_anchor", "subsection", "subsection_anchor"]]))


# ------------------------------------------------------------------ chunkers
def window_chunks(words: list[str], size: int, step: int) -> list[str]:
    """B4w: windows of ``size`` words every ``step`` words; the last window
    ends the text. No words -> no chunk."""
    n = len(words)
    if n == 0:
        return []
    out, s = [], 0
    while True:
        out.append(" ".join(words[s:s + size]))
        if s + size >= n:
            return out
        s += step


_BREAK = re.compile(f"{PARAGRAPH_SEP}|{SENTENCE_END_RE}")
_WORD = re.compile(r"\S+")


def _pieces(text: str, size: int) -> list[tuple[int, int, int]]:
    """Stretches ``(start, end, words)`` of the text, of at most ``size`` words: paragraphs ->
    sentences -> clauses (which end with a word that ends in a mark) -> words."""
    out: list[tuple[int, int, int]] = []

    def add(words: list[tuple[int, int]]) -> None:
        if len(words) <= size:
            out.append((words[0][0], words[-1][1], len(words)))
        else:
            out.extend((a, b, 1) for a, b in words)
    at = 0
    for end, after in [*(m.span() for m in _BREAK.finditer(text)), (len(text), len(text))]:
        words = [m.span() for m in _WORD.finditer(text, at, end)]
        at = after
        if len(words) <= size:
            if words:
                add(words)
            continue
        clause: list[tuple[int, int]] = []
        for w in words:
            clause.append(w)
            if text[w[1] - 1] in CLAUSE_ENDS:
                add(clause)
                clause = []
        if clause:
            add(clause)
    return out


def sentence_chunks(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> list[str]:
    """Greedy sentence packing to at most ``size`` words; each chunk after
    the first starts with trailing pieces of the previous one totalling at
    most ``overlap`` words, and always adds at least one new piece. A chunk is a stretch
    of the text as it stands, blanks and line breaks included."""
    pieces = _pieces(text or "", size)
    chunks: list[str] = []
    first, words = 0, 0  # of the open chunk
    for i, (_, _, n) in enumerate(pieces):
        if words + n > size:
            chunks.append(text[pieces[first][0]:pieces[i - 1][1]])
            first, words = i, 0
            while first > 0 and words + pieces[first - 1][2] <= min(overlap, size - n):
                first -= 1
                words += pieces[first][2]
        words += n
    if pieces:
        chunks.append(text[pieces[first][0]:pieces[-1][1]])
    return chunks


def _chunk_udf(mode: str, size: int, overlap: int):
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def chunker(texts: pd.Series) -> pd.Series:
        if mode == "window":
            return texts.map(lambda t: window_chunks((t or "").split(), size, size - overlap))
        return texts.map(lambda t: sentence_chunks(t or "", size, overlap))
    return chunker


def chunk(documents: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, *,
          mode: str = "sentence", id_col: str = "doc_id", text_col: str = "text",
          layout: str = "dense") -> DataFrame:
    """Chunk every document; metadata columns ride along unchanged.

    Returns the document columns (text replaced by the chunk text) plus
    ``chunk_no`` and ``node_id`` (B5, see ``with_chunk_id`` for ``layout``).
    """
    if overlap >= size:
        raise ValueError("overlap must be smaller than the chunk size")
    meta = [c for c in documents.columns if c != text_col]
    exploded = (documents.select(*meta, *gen_rows(_chunk_udf(mode, size, overlap)(F.col(text_col)),
                                                  "text", "chunk_no"))
                .where(F.col("chunk_no").isNotNull()))
    return with_chunk_id(exploded, id_col, layout)


def with_chunk_id(df: DataFrame, id_col: str = "doc_id", layout: str = "dense") -> DataFrame:
    """Deterministic id, equal on every re-run.

    ``dense``: ``doc_id * 2^20 + chunk_no`` for document ids below 2^43; a larger id or a
    chunk_no from 2^20 on fails the task. ``hash``: a 64-bit hash of both, for ids that
    are hashes themselves (``with_doc_id``)."""
    if layout == "hash":
        return df.withColumn("node_id", F.xxhash64(F.col(id_col), F.col("chunk_no").cast("long")))
    if layout != "dense":
        raise ValueError(f"unknown id layout {layout!r}")
    guard = F.assert_true(F.col("chunk_no") < F.lit(1 << CHUNK_BITS),
                          F.lit("chunk_no does not fit the id layout"))
    return df.withColumn("node_id", F.when(guard.isNull(),
                                           F.col(id_col).cast("long") * F.lit(1 << CHUNK_BITS)
                                           + F.col("chunk_no").cast("long")))


def with_node_columns(chunks: DataFrame, model_name: str) -> DataFrame:
    """``deleted=false``, word tokens and the embedding model name."""
    return (chunks.withColumn("deleted", F.lit(False))
            .withColumn("tokenized_text", token_col("text"))
            .withColumn("embedding_model", F.lit(model_name)))


def check_metadata(chunks: DataFrame, documents: DataFrame, id_col: str = "doc_id") -> None:
    """B3 integrity: every chunk's source document must exist (anti join)."""
    bad = chunks.select(id_col).join(documents.select(id_col), id_col, "left_anti").first()
    if bad is not None:
        raise ValueError(f"chunks name id {bad[0]}, which the documents table does not have")
