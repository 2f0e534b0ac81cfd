"""DuckDB twins of the registered queries (the correctness oracle).

Same tables, same parameters, same output column names as ``catalog.py``.
Regex classes avoid ``\\w`` / ``\\s`` so RE2 and Java agree (see
``functions/text.py``); hashes use md5 / sha256, equal in both engines.
"""

from __future__ import annotations

from ..functions.text import EDGE_WS, TOKEN, WORD_RUN, WS_RUN
from ..operators.dedup import BANDS, NUM_PERM, PRIME, ROWS, SHINGLE, perm_constants
from .catalog import BM25_K, FUSE_K, LAYER_TTL, NLIST_PROBE, SEM_THRESHOLD, TTL, VEC_K


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def norm_dedup(col: str) -> str:
    return (f"regexp_replace(regexp_replace(lower({col}), {_q(EDGE_WS)}, '', 'g'), "
            f"{_q(WS_RUN)}, ' ', 'g')")


def norm_cache(col: str) -> str:
    return f"regexp_replace(lower({col}), {_q(WS_RUN)}, '', 'g')"


def terms(col: str) -> str:
    return f"regexp_extract_all(lower({col}), {_q(WORD_RUN)})"


def ws_words(col: str) -> str:
    n = f"regexp_replace({col}, {_q(EDGE_WS)}, '', 'g')"
    return f"(CASE WHEN {n} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({n}, {_q(WS_RUN)}) END)"


def dot(a: str, b: str) -> str:
    return f"list_dot_product(({a})::DOUBLE[], ({b})::DOUBLE[])"


def perms_values() -> str:
    a, b = perm_constants(NUM_PERM)
    return ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(zip(a, b)))


# ------------------------------------------------------------------ building blocks
def bm25_ctes(k: int, queries: str = "SELECT item_id AS query_id, text FROM benchmark") -> str:
    return f"""
docs AS (SELECT doc_id AS node_id, {terms('text')} AS terms FROM documents),
stats AS (SELECT count(*) AS n, avg(len(terms)) AS avgdl FROM docs),
tf AS (SELECT node_id, dl, term, count(*) AS tf
       FROM (SELECT node_id, len(terms) AS dl, unnest(terms) AS term FROM docs) GROUP BY ALL),
dfreq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
idf AS (SELECT term, ln(1 + ((SELECT n FROM stats) - df + 0.5) / (df + 0.5)) AS idf FROM dfreq),
bq AS ({queries}),
qt AS (SELECT DISTINCT query_id, unnest(list_distinct({terms('text')})) AS term FROM bq),
bm_scored AS (
  SELECT qt.query_id, tf.node_id,
         sum(idf.idf * tf.tf * 2.5 / (tf.tf + 1.5 * (0.25 + 0.75 * tf.dl / (SELECT avgdl FROM stats)))) AS score
  FROM qt JOIN tf USING (term) JOIN idf USING (term) GROUP BY ALL),
bm AS (SELECT query_id, node_id, score,
              row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, node_id) AS rank
       FROM bm_scored WHERE score > 0 QUALIFY rank <= {k})"""


def vec_ctes(k: int) -> str:
    return f"""
vq AS (SELECT b.item_id AS query_id, e.embedding FROM benchmark b JOIN embeddings e ON e.vec_id = b.item_id),
vec AS (SELECT query_id, node_id, score,
               row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, node_id) AS rank
        FROM (SELECT q.query_id, c.vec_id AS node_id, {dot('q.embedding', 'c.embedding')} AS score
              FROM vq q, embeddings c) QUALIFY rank <= {k})"""


def fused_ctes(mode: str = "relative") -> str:
    base = bm25_ctes(FUSE_K) + "," + vec_ctes(FUSE_K)
    if mode == "relative":
        contrib = ("CASE WHEN hi = lo THEN (CASE WHEN hi > 0 THEN 1.0 ELSE 0.0 END) "
                   "ELSE (score - lo) / (hi - lo) END * w")
        lists = """lists AS (SELECT query_id, node_id, score, 'vector' AS r, 0.75 AS w FROM vec
                 UNION ALL SELECT query_id, node_id, score, 'bm25' AS r, 0.25 AS w FROM bm),
  scaled AS (SELECT *, min(score) OVER (PARTITION BY query_id, r) AS lo,
                       max(score) OVER (PARTITION BY query_id, r) AS hi FROM lists)"""
    else:
        contrib = "w / (60 + rank)"
        lists = """lists AS (SELECT query_id, node_id, score, rank, 'vector' AS r, 0.5 AS w FROM vec
                 UNION ALL SELECT query_id, node_id, score, rank, 'bm25' AS r, 0.5 AS w FROM bm),
  scaled AS (SELECT * FROM lists)"""
    return base + f""",
  {lists},
  fsum AS (SELECT query_id, node_id, sum({contrib}) AS score FROM scaled GROUP BY ALL),
  fused AS (SELECT query_id, node_id, score,
                   row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, node_id) AS rank
            FROM fsum QUALIFY rank <= {FUSE_K})"""


def minhash_ctes(src: str, scope: str | None = None) -> str:
    """src: relation with (id, text[, scope]). Produces sh, sig, sigl."""
    sc = f"{scope}, " if scope else ""
    return f"""
mh_n AS (SELECT {sc}id, string_split({norm_dedup('text')}, ' ') AS toks FROM ({src})),
sh AS (SELECT {sc}id, 0::BIGINT AS shingle_no, array_to_string(toks, ' ') AS shingle FROM mh_n WHERE len(toks) <= {SHINGLE}
       UNION ALL
       SELECT {sc}id, i - 1 AS shingle_no, array_to_string(toks[i:i + {SHINGLE - 1}], ' ') AS shingle
       FROM (SELECT {sc}id, toks, unnest(generate_series(1, len(toks) - {SHINGLE - 1})) AS i
             FROM mh_n WHERE len(toks) > {SHINGLE})),
shh AS (SELECT DISTINCT {sc}id, ('0x' || substr(md5(shingle), 1, 8))::BIGINT % {PRIME} AS h FROM sh),
perms(perm_no, a, b) AS (VALUES {perms_values()}),
sig AS (SELECT {sc}id, perm_no, min((a * h + b) % {PRIME}) AS minhash FROM shh, perms GROUP BY ALL),
sigl AS (SELECT {sc}id, list(minhash ORDER BY perm_no) AS s FROM sig GROUP BY ALL)"""


def lsh_ctes(scope: str | None = None) -> str:
    sc_eq = f" AND x.{scope} = y.{scope}" if scope else ""
    sc = f"x.{scope}, " if scope else ""
    return f""",
bands AS (SELECT {'' if not scope else scope + ', '}id, s, unnest(generate_series(0, {BANDS - 1})) AS band FROM sigl),
cand AS (SELECT DISTINCT {sc}x.id AS id_a, y.id AS id_b, x.s AS sa, y.s AS sb
         FROM bands x JOIN bands y ON x.band = y.band{sc_eq}
           AND x.s[x.band * {ROWS} + 1 : x.band * {ROWS} + {ROWS}] = y.s[y.band * {ROWS} + 1 : y.band * {ROWS} + {ROWS}]
         WHERE x.id < y.id),
near AS (SELECT {'' if not scope else scope + ', '}id_a, id_b,
                list_sum(list_transform(generate_series(1, {NUM_PERM}), lambda i: (sa[i] = sb[i])::INT)) / {NUM_PERM}.0 AS jaccard
         FROM cand)"""


def greedy_ctes(prefix: str, edges: str, rank: str) -> str:
    """edges: relation (a, b) of undirected matches between node keys;
    rank: relation (id, pos) giving the total order. Produces {prefix}_dropped(id)."""
    p = prefix
    return f""",
{p}_e AS (SELECT CASE WHEN ra.pos < rb.pos THEN e.a ELSE e.b END AS u,
                 CASE WHEN ra.pos < rb.pos THEN e.b ELSE e.a END AS v
          FROM ({edges}) e JOIN ({rank}) ra ON ra.id = e.a JOIN ({rank}) rb ON rb.id = e.b),
{p}_n AS (SELECT v AS id, list(u) AS ups, row_number() OVER (ORDER BY min(r.pos)) AS step
          FROM {p}_e JOIN ({rank}) r ON r.id = {p}_e.v GROUP BY v),
{p}_walk(step, dropped) AS (
  SELECT 0::BIGINT, []::BIGINT[]
  UNION ALL
  SELECT w.step + 1,
         CASE WHEN len(list_filter(n.ups, lambda x: NOT list_contains(w.dropped, x))) > 0
              THEN list_append(w.dropped, n.id) ELSE w.dropped END
  FROM {p}_walk w JOIN {p}_n n ON n.step = w.step + 1),
{p}_dropped AS (SELECT unnest(dropped) AS id FROM {p}_walk WHERE step = (SELECT max(step) FROM {p}_walk))"""


# ------------------------------------------------------------------ queries
def sql_vector_topk() -> str:
    return f"""
SELECT query_id, node_id, rank, round(score, 6) AS score FROM (
  SELECT query_id, node_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, node_id) AS rank
  FROM (SELECT q.vec_id AS query_id, c.vec_id AS node_id, {dot('q.embedding', 'c.embedding')} AS score
        FROM embeddings q, embeddings c WHERE q.vec_id <> c.vec_id))
WHERE rank <= {VEC_K}"""


def sql_bm25_topk() -> str:
    return "WITH " + bm25_ctes(BM25_K) + "\nSELECT query_id, node_id, rank, round(score, 6) AS score FROM bm"


def sql_fusion(mode: str) -> str:
    return "WITH " + fused_ctes(mode) + "\nSELECT query_id, node_id, rank, round(score, 6) AS score FROM fused"


def _bench_filters() -> str:
    return """qf AS (SELECT b.item_id AS query_id, d.lang AS category,
                 CASE WHEN d.lang = 'de' THEN d.source END AS product
          FROM benchmark b LEFT JOIN documents d ON d.doc_id = b.item_id)"""


def sql_metadata_filter() -> str:
    return "WITH " + fused_ctes() + ",\n" + _bench_filters() + """
SELECT f.query_id, f.node_id, f.rank, round(f.score, 6) AS score
FROM fused f LEFT JOIN documents d ON d.doc_id = f.node_id LEFT JOIN qf ON qf.query_id = f.query_id
WHERE (qf.product IS NULL OR coalesce(d.source = qf.product, false))
  AND (qf.category IS NULL OR coalesce(d.lang = qf.category, false))"""


def sql_score_cutoff() -> str:
    return "WITH " + fused_ctes() + "\nSELECT query_id, node_id, rank, round(score, 6) AS score FROM fused WHERE score >= 0.6"


def sql_query_variants() -> str:
    return "WITH " + bm25_ctes(10) + f""",
fb AS (SELECT bm.query_id, tf.term, sum(tf.tf * idf.idf) AS w
       FROM bm JOIN tf ON tf.node_id = bm.node_id JOIN idf ON idf.term = tf.term GROUP BY ALL),
ex AS (SELECT * FROM fb WHERE NOT EXISTS (SELECT 1 FROM qt WHERE qt.query_id = fb.query_id AND qt.term = fb.term)),
rk AS (SELECT query_id, term, row_number() OVER (PARTITION BY query_id ORDER BY round(w, 9) DESC, term) AS v
       FROM ex QUALIFY v <= 2)
SELECT query_id, 0 AS variant_no, text FROM bq
UNION ALL
SELECT rk.query_id, rk.v::INTEGER AS variant_no, bq.text || ' ' || rk.term AS text FROM rk JOIN bq USING (query_id)"""


def sql_exact_dedup() -> str:
    return f"""
SELECT min(doc_id) AS doc_id, fp AS fingerprint
FROM (SELECT doc_id, sha256({norm_dedup('text')}) AS fp FROM documents) GROUP BY fp"""


DOC_SRC = "SELECT doc_id AS id, text FROM documents"


def sql_shingles() -> str:
    return "WITH " + minhash_ctes(DOC_SRC) + "\nSELECT id AS doc_id, shingle_no, shingle FROM sh"


def sql_minhash_signature() -> str:
    return "WITH " + minhash_ctes(DOC_SRC) + "\nSELECT id AS doc_id, perm_no::BIGINT AS perm_no, minhash FROM sig"


def sql_lsh_candidates() -> str:
    return "WITH " + minhash_ctes(DOC_SRC) + lsh_ctes() + "\nSELECT id_a AS doc_a, id_b AS doc_b FROM cand"


def sql_near_dup_pairs() -> str:
    return ("WITH RECURSIVE " + minhash_ctes(DOC_SRC) + lsh_ctes()
            + "\nSELECT id_a AS doc_a, id_b AS doc_b, round(jaccard, 6) AS jaccard FROM near WHERE jaccard >= 0.9")


def _near_dedup_body(src: str) -> str:
    return (minhash_ctes(src) + lsh_ctes()
            + greedy_ctes("nd", "SELECT id_a AS a, id_b AS b FROM near WHERE jaccard >= 0.9",
                          "SELECT id, id AS pos FROM sigl"))


def sql_near_dedup() -> str:
    return ("WITH RECURSIVE " + _near_dedup_body(DOC_SRC)
            + "\nSELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT id FROM nd_dropped)")


def _sem_pairs(src: str, threshold: float = SEM_THRESHOLD) -> str:
    return f"""SELECT x.id AS a, y.id AS b, {dot('x.embedding', 'y.embedding')} AS sim
               FROM ({src}) x JOIN ({src}) y ON x.id < y.id
               WHERE {dot('x.embedding', 'y.embedding')} >= {threshold}"""


def sql_semantic_pairs() -> str:
    return f"""SELECT a AS vec_a, b AS vec_b, round(sim, 6) AS similarity
FROM ({_sem_pairs('SELECT vec_id AS id, embedding FROM embeddings')})"""


def sql_semantic_dedup() -> str:
    src = "SELECT vec_id AS id, embedding FROM embeddings"
    return ("WITH RECURSIVE pairs AS (" + _sem_pairs(src) + ")"
            + greedy_ctes("sd", "SELECT a, b FROM pairs", "SELECT vec_id AS id, vec_id AS pos FROM embeddings")
            + "\nSELECT vec_id FROM embeddings WHERE vec_id NOT IN (SELECT id FROM sd_dropped)")


def sql_dedup_chain() -> str:
    vectors = "SELECT n2.id, h.v AS embedding FROM n2 JOIN he_dense h ON h.id = n2.id"
    return f"""WITH RECURSIVE
nodes AS (SELECT doc_id AS id, text FROM documents),
{hashed_ctes("SELECT id, text FROM nodes")},
ex AS (SELECT min(id) AS id FROM (SELECT id, sha256({norm_dedup('text')}) AS fp FROM nodes) GROUP BY fp),
n1 AS (SELECT * FROM nodes WHERE id IN (SELECT id FROM ex)),""" + _near_dedup_body("SELECT id, text FROM n1") + f""",
n2 AS (SELECT * FROM n1 WHERE id NOT IN (SELECT id FROM nd_dropped)),
pairs AS ({_sem_pairs(vectors, 0.9)})""" + greedy_ctes(
        "sd", "SELECT a, b FROM pairs", "SELECT id, id AS pos FROM n2") + """
SELECT id AS node_id FROM n2 WHERE id NOT IN (SELECT id FROM sd_dropped)"""


def sql_tokenize() -> str:
    t = f"regexp_extract_all(text, {_q(TOKEN)})"
    return f"""SELECT doc_id, len({t})::BIGINT AS n_tokens, sha256(array_to_string({t}, chr(31))) AS tokens_sha
FROM documents"""


def sql_chunk_windows() -> str:
    return f"""
WITH w AS (SELECT doc_id, {ws_words('text')} AS words FROM documents),
s AS (SELECT doc_id, words, unnest(generate_series(0, CASE WHEN len(words) <= 100 THEN 0
                                               ELSE ceil((len(words) - 100) / 70.0)::BIGINT END)) AS chunk_no
      FROM w WHERE len(words) > 0)
SELECT doc_id, chunk_no::BIGINT AS chunk_no, doc_id * 1048576 + chunk_no AS node_id,
       len(words[chunk_no * 70 + 1 : chunk_no * 70 + 100])::BIGINT AS n_words,
       array_to_string(words[chunk_no * 70 + 1 : chunk_no * 70 + 100], ' ') AS text
FROM s"""


def sql_flatten_articles() -> str:
    return """
SELECT CAST(u.conv_id AS VARCHAR) AS article_id, 'turn-' || u.turn AS section, '#t' || u.turn AS section_anchor,
       NULL::VARCHAR AS subsection, NULL::VARCHAR AS subsection_anchor, u.text
FROM conversations u WHERE u.role <> 'assistant' AND length(u.text) > 0
UNION ALL
SELECT CAST(u.conv_id AS VARCHAR), 'turn-' || u.turn, '#t' || u.turn, 'reply-' || a.turn, '#r' || a.turn, a.text
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role <> 'assistant'"""


def hashed_ctes(src: str, dim: int = 64, prefix: str = "he") -> str:
    """src: (id, text) -> {prefix}(id, b, v) normalised non-zero entries."""
    p = prefix
    return f"""
{p}_t AS (SELECT id, md5(t) AS h FROM (SELECT id, unnest({terms('text')}) AS t FROM ({src}))),
{p}_b AS (SELECT id, (('0x' || substr(h, 1, 8))::BIGINT % {dim}) AS b,
                 sum(CASE WHEN ('0x' || substr(h, 9, 1))::INT % 2 = 0 THEN 1 ELSE -1 END) AS v
          FROM {p}_t GROUP BY ALL),
{p}_n AS (SELECT id, sqrt(sum(v * v)) AS norm FROM {p}_b GROUP BY id),
{p} AS (SELECT id, b, (v / norm)::FLOAT AS val FROM {p}_b JOIN {p}_n USING (id) WHERE norm > 0),
{p}_ids AS (SELECT DISTINCT id FROM {p}),
{p}_dense AS (SELECT i.id, list(coalesce(h.val, 0.0::FLOAT) ORDER BY g.j) AS v
              FROM {p}_ids i CROSS JOIN (SELECT unnest(generate_series(0, {dim - 1})) AS j) g
              LEFT JOIN {p} h ON h.id = i.id AND h.b = g.j GROUP BY i.id)"""


def sql_corpus_build() -> str:
    chunks = "SELECT id, text FROM k"
    return f"""
WITH docs AS ({sql_flatten_articles()}),
w AS (SELECT article_id, section, subsection, {ws_words('text')} AS words FROM docs),
s AS (SELECT *, unnest(generate_series(0, CASE WHEN len(words) <= 100 THEN 0
                                       ELSE ceil((len(words) - 100) / 70.0)::BIGINT END)) AS chunk_no
      FROM w WHERE len(words) > 0),
k AS (SELECT *, row_number() OVER () AS id, array_to_string(words[chunk_no * 70 + 1 : chunk_no * 70 + 100], ' ') AS text FROM s),
{hashed_ctes(chunks)},
z AS (SELECT id, count(*) AS n FROM he WHERE val <> 0 GROUP BY id)
SELECT article_id, section, subsection, chunk_no::BIGINT AS chunk_no, text,
       len(regexp_extract_all(text, {_q(TOKEN)}))::BIGINT AS n_tokens, false AS deleted, coalesce(z.n, 0)::BIGINT AS n_nonzero
FROM k LEFT JOIN z USING (id)"""


def sql_embed_hashed() -> str:
    return ("WITH " + hashed_ctes("SELECT doc_id AS id, text FROM documents")
            + "\nSELECT id AS doc_id, b AS dim_no, round(val::FLOAT, 6) AS value FROM he WHERE val <> 0")


def sql_l2_normalize() -> str:
    return """
WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * (label + 2)) AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x::DOUBLE * x::DOUBLE))) AS norm FROM s)
SELECT vec_id, round(norm, 6) AS norm_before, (i - 1)::BIGINT AS dim_no, round(v[i] / norm, 6) AS value
FROM (SELECT *, unnest(generate_series(1, len(v))) AS i FROM n)"""


def sql_validate_embeddings() -> str:
    return """
WITH h AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, unnest(""" + terms("text") + """) AS t FROM documents)),
allv AS (SELECT vec_id AS node_id, len(embedding) AS d FROM embeddings
         UNION ALL SELECT doc_id + 1000000, CASE WHEN doc_id IN (SELECT doc_id FROM h) THEN 64 END FROM documents)
SELECT count(*)::BIGINT AS n_rows, count(*) FILTER (WHERE d IS NULL)::BIGINT AS n_null,
       count(*) FILTER (WHERE d IS NOT NULL AND d <> 64)::BIGINT AS n_wrong_dim,
       coalesce(min(CASE WHEN d IS NULL OR d <> 64 THEN node_id END), -1)::BIGINT AS first_bad_id
FROM allv"""


def sql_active_chunks() -> str:
    return """SELECT d.doc_id FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE NOT coalesce(l.toxic = 1, false)"""


def centroid_ctes() -> str:
    return """
cents_raw AS (SELECT label AS list_id, list(x ORDER BY j) AS c FROM (
    SELECT label, j, avg(x) AS x FROM (SELECT label, unnest(embedding) AS x, unnest(generate_series(0, len(embedding) - 1)) AS j
                                       FROM embeddings) GROUP BY ALL) GROUP BY label),
cents AS (SELECT list_id, list_transform(c, lambda x: (x::FLOAT::DOUBLE / sqrt(list_sum(list_transform(c, lambda y: y::FLOAT::DOUBLE * y::FLOAT::DOUBLE))))::FLOAT) AS c
          FROM cents_raw),
nv AS (SELECT vec_id, list_transform(embedding, lambda x: (x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE))))::FLOAT) AS embedding FROM embeddings),
asg AS (SELECT vec_id, list_id, score FROM (
    SELECT nv.vec_id, cents.list_id, """ + dot("nv.embedding", "cents.c") + """ AS score FROM nv, cents)
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, list_id) = 1)"""


def sql_ivf_assign() -> str:
    return "WITH " + centroid_ctes() + "\nSELECT vec_id, list_id, round(score, 6) AS score FROM asg"


def _probe_ctes() -> str:
    return centroid_ctes() + f""",
probes AS (SELECT query_id, list_id FROM (
    SELECT q.vec_id AS query_id, cents.list_id, {dot('q.embedding', 'cents.c')} AS s FROM embeddings q, cents)
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, list_id) <= {NLIST_PROBE})"""


def sql_ivf_probe() -> str:
    return "WITH " + _probe_ctes() + f"""
SELECT query_id, node_id, rank, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, node_id) AS rank FROM (
  SELECT p.query_id, a.vec_id AS node_id, {dot('q.embedding', 'nv.embedding')} AS score
  FROM probes p JOIN asg a ON a.list_id = p.list_id JOIN embeddings q ON q.vec_id = p.query_id
  JOIN nv ON nv.vec_id = a.vec_id WHERE a.vec_id <> p.query_id))
WHERE rank <= {VEC_K}"""


def codebook_ctes() -> str:
    return """
cb AS (SELECT m, code, list(x ORDER BY i) AS c FROM (
    SELECT j // 2 AS m, (label >= 5)::INT AS code, j % 2 AS i, avg(x) AS x
    FROM (SELECT label, unnest(embedding) AS x, unnest(generate_series(0, len(embedding) - 1)) AS j FROM embeddings)
    GROUP BY ALL) GROUP BY ALL)"""


def _codes_cte(src: str = "embeddings") -> str:
    return f"""
codes AS (SELECT vec_id, m, code FROM (
    SELECT e.vec_id, cb.m, cb.code,
           (e.embedding[cb.m * 2 + 1]::DOUBLE - cb.c[1]) ** 2 + (e.embedding[cb.m * 2 + 2]::DOUBLE - cb.c[2]) ** 2 AS dist
    FROM {src} e, cb)
    QUALIFY row_number() OVER (PARTITION BY vec_id, m ORDER BY dist, code) = 1)"""


def sql_pq_encode() -> str:
    return "WITH " + codebook_ctes() + "," + _codes_cte() + "\nSELECT vec_id, m::BIGINT AS m, code::BIGINT AS code FROM codes"


def sql_pq_train(rounds: int = 25) -> str:
    """Lloyd steps from the label split, one table each."""
    steps = "".join(f""",
it{i} AS MATERIALIZED (
  SELECT b.m, b.code, coalesce(n.c1, b.c1) AS c1, coalesce(n.c2, b.c2) AS c2
  FROM it{i - 1} b LEFT JOIN (
    SELECT m, code, avg(x1) AS c1, avg(x2) AS c2 FROM (
      SELECT s.vec_id, s.m, s.x1, s.x2, o.code FROM subs s JOIN it{i - 1} o ON o.m = s.m
      QUALIFY row_number() OVER (PARTITION BY s.vec_id, s.m ORDER BY (s.x1 - o.c1) ** 2 + (s.x2 - o.c2) ** 2, o.code) = 1)
    GROUP BY m, code) n ON n.m = b.m AND n.code = b.code)""" for i in range(1, rounds + 1))
    return "WITH " + codebook_ctes() + """,
subs AS MATERIALIZED (SELECT vec_id, j AS m, embedding[2 * j + 1]::DOUBLE AS x1, embedding[2 * j + 2]::DOUBLE AS x2
                      FROM (SELECT vec_id, embedding, unnest(range(32)) AS j FROM embeddings)),
it0 AS MATERIALIZED (SELECT m, code, c[1] AS c1, c[2] AS c2 FROM cb)""" + steps + f"""
SELECT m::BIGINT AS m, code::BIGINT AS code, d::BIGINT AS dim_no, round(CASE d WHEN 0 THEN c1 ELSE c2 END, 6) AS value
FROM it{rounds}, (SELECT unnest([0, 1]) AS d)"""


def sql_pq_search() -> str:
    return "WITH " + _probe_ctes() + "," + codebook_ctes() + "," + _codes_cte("nv") + f""",
lut AS (SELECT q.vec_id AS query_id, cb.m, cb.code,
               q.embedding[cb.m * 2 + 1]::DOUBLE * cb.c[1] + q.embedding[cb.m * 2 + 2]::DOUBLE * cb.c[2] AS s
        FROM embeddings q, cb),
cand AS (SELECT p.query_id, a.vec_id AS node_id FROM probes p JOIN asg a ON a.list_id = p.list_id
         WHERE a.vec_id <> p.query_id),
sc AS (SELECT cand.query_id, cand.node_id, sum(lut.s) AS score
       FROM cand JOIN codes ON codes.vec_id = cand.node_id
       JOIN lut ON lut.query_id = cand.query_id AND lut.m = codes.m AND lut.code = codes.code GROUP BY ALL)
SELECT query_id, node_id, rank, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, node_id) AS rank FROM sc)
WHERE rank <= {VEC_K}"""


def _turns_sql() -> str:
    return f"""
u AS (SELECT conv_id, turn, text, {norm_cache('text')} AS q,
             CASE WHEN turn = 0 THEN NULL
                  ELSE '{{"conv":' || to_json(conv_id::VARCHAR) || ',"turn":' || to_json(turn::VARCHAR) || '}}' END AS fj
      FROM conversations)"""


def sql_cache_key_exact() -> str:
    return "WITH " + _turns_sql() + """
SELECT conv_id, turn, 'exact_cache:' || sha256('{"metadata_filters":' || coalesce(fj, '{}') || ',"query":' || to_json(q)
       || ',"rag_pipeline_version":"v1","tenant_id":"default"}') AS cache_key FROM u"""


def sql_cache_key_semantic() -> str:
    return "WITH " + _turns_sql() + """
SELECT conv_id, turn, 'semantic_cache:' || sha256(coalesce(fj, 'null') || ':v1:default:' || q) AS cache_key,
       sha256(coalesce(fj, 'null')) AS filters_hash FROM u"""


def _event_key(tenant: str = "'default'") -> str:
    return (f"""'exact_cache:' || sha256('{{"metadata_filters":{{}},"query":' || to_json({norm_cache('props')})"""
            f""" || ',"rag_pipeline_version":"v1","tenant_id":' || to_json({tenant}) || '}}')""")


def _event_log_sql() -> str:
    return f"""
lg AS (SELECT event_id, ts, {_event_key()} AS k,
              CASE WHEN event_type = 'purchase' THEN 'set' WHEN event_type = 'error' THEN 'delete' ELSE 'get' END AS op,
              CASE WHEN event_type = 'purchase' THEN 'resp-' || event_id END AS resp
       FROM events)"""


def sql_cache_get_asof() -> str:
    return "WITH " + _event_log_sql() + f""",
seen AS (SELECT *, last_value(CASE WHEN op <> 'get' THEN {{'t': ts, 'op': op, 'resp': resp}} END IGNORE NULLS)
                   OVER (PARTITION BY k ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
         FROM lg)
SELECT event_id, coalesce(prev.op = 'set' AND ts < prev.t + INTERVAL {TTL} SECOND, false) AS hit,
       CASE WHEN prev.op = 'set' AND ts < prev.t + INTERVAL {TTL} SECOND THEN prev.resp END AS response
FROM seen WHERE op = 'get'"""


def sql_cache_put_delete() -> str:
    return "WITH " + _event_log_sql() + f""",
lastw AS (SELECT k, arg_max({{'op': op, 'resp': resp, 'ts': ts}}, (ts, event_id)) AS l FROM lg WHERE op <> 'get' GROUP BY k)
SELECT k AS cache_key, l.resp AS response, l.ts AS set_ts FROM lastw
WHERE l.op = 'set' AND (SELECT max(ts) FROM events) < l.ts + INTERVAL {TTL} SECOND"""


def _replay_ctes() -> str:
    return f"""
r AS (SELECT event_id, ts, event_type, {_event_key('event_type')} AS k FROM events),
rn AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, event_id) AS i FROM r),
walk(k, i, event_id, last_set, outcome) AS (
  SELECT k, i, event_id, ts, 'miss' FROM rn WHERE i = 1
  UNION ALL
  SELECT n.k, n.i, n.event_id,
         CASE WHEN n.ts >= w.last_set + INTERVAL {TTL} SECOND THEN n.ts ELSE w.last_set END,
         CASE WHEN n.ts >= w.last_set + INTERVAL {TTL} SECOND THEN 'miss' ELSE 'hit' END
  FROM walk w JOIN rn n ON n.k = w.k AND n.i = w.i + 1)"""


def sql_cache_ttl_replay() -> str:
    return "WITH RECURSIVE " + _replay_ctes() + "\nSELECT event_id, outcome FROM walk"


def sql_cache_outcomes() -> str:
    return "WITH RECURSIVE " + _replay_ctes() + """
SELECT date_trunc('day', r.ts) AS window_start, r.event_type AS tenant_id, w.outcome, count(*)::BIGINT AS n
FROM walk w JOIN r USING (event_id) GROUP BY ALL"""


def sql_cache_two_layer() -> str:
    # On these tables the semantic layer never answers (the judge needs equal
    # term sets, which here means an equal exact key), so the two-layer
    # outcome is the exact-layer replay.
    return ("WITH RECURSIVE " + _replay_ctes()
            + "\nSELECT event_id, CASE WHEN outcome = 'hit' THEN 'exact_hit' ELSE 'miss' END AS outcome FROM walk")


def sql_cache_fill() -> str:
    return ("WITH RECURSIVE " + _replay_ctes()
            + "\nSELECT event_id, 'This is a fake response.' AS response FROM walk WHERE outcome = 'miss'")


def _layer_ctes(plain: bool = False) -> str:
    """The layered log (of ``plain`` texts or of their variants) walked request by request: ``lwalk(rid, outcome, source, sim)`` of every event, null for sets and deletes."""
    live = "list_filter(w.se, lambda x: x.f = l.f AND l.t < x.t + {ttl} AND l.q IS NOT NULL)".format(ttl=LAYER_TTL * 1_000_000)
    cand = f"list_sort(list_transform({live}, lambda x: {{'s': -coalesce(l.near[x.q], -2.0), 'k': x.k, 'src': x.src, 'q': x.q}}))[1]"
    found = f"list_filter(w.ex, lambda x: x.k = l.ek AND l.t < x.t + {LAYER_TTL * 1_000_000})[1]"
    query = "b.text" if plain else """CASE e.event_id % 4
                WHEN 1 THEN substr(b.text, instr(b.text, ' ') + 1) || ' ' || substr(b.text, 1, instr(b.text, ' ') - 1)
                WHEN 2 THEN b.text || ' please' ELSE b.text END"""
    keep = "list_filter({col}, lambda x: x.k <> {key} AND l.t < x.t + " + str(LAYER_TTL * 1_000_000) + ")"
    return f"""
lg AS (SELECT e.event_id AS rid, epoch_us(e.ts) AS t, e.user_id % 5 AS tenant, e.event_id % 3 AS f,
              CASE WHEN e.event_type = 'purchase' AND e.event_id % 2 = 0 THEN 'set'
                   WHEN e.event_type = 'error' AND e.event_id % 2 = 0 THEN 'delete' ELSE 'get' END AS op,
              CASE e.event_id % 5 WHEN 0 THEN 'exact' WHEN 1 THEN 'semantic' ELSE 'both' END AS layer,
              {query} AS query
       FROM events e JOIN benchmark b ON b.item_id = e.user_id % (SELECT count(*) FROM benchmark)),
lq AS (SELECT query, row_number() OVER (ORDER BY query) AS q FROM (SELECT DISTINCT query FROM lg)),
{hashed_ctes("SELECT q AS id, query AS text FROM lq", 64, "lh")},
lt AS (SELECT q, list_sort(list_distinct({terms('query')})) AS t FROM lq),
lsim AS (SELECT a.id AS a, b.id AS b, round({dot('a.v', 'b.v')}, 9) AS sim FROM lh_dense a, lh_dense b WHERE {dot('a.v', 'b.v')} >= 0.9),
lnear AS (SELECT a AS q, map(list(b), list(sim)) AS near, map(list(b), list(x.t = y.t)) AS same
          FROM lsim JOIN lt x ON x.q = a JOIN lt y ON y.q = b GROUP BY a),
lk AS (SELECT lg.*, lq.q, lnear.near, lnear.same, tenant || (CASE WHEN f = 2 THEN '-de' ELSE '-' END) AS part,
              {norm_cache('query')} AS ek,
              'semantic_cache:' || sha256(CASE f WHEN 0 THEN 'null' WHEN 1 THEN '{{}}' ELSE '{{"category":"de"}}' END
                || ':v1:t' || tenant || ':' || {norm_cache('query')}) AS sk
       FROM lg JOIN lq USING (query) LEFT JOIN lnear ON lnear.q = lq.q),
ln AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY t, rid) AS i FROM lk),
lwalk(part, i, rid, outcome, source, sim, ex, se) AS (
  SELECT DISTINCT part, 0::BIGINT, NULL::BIGINT, NULL::VARCHAR, NULL::BIGINT, NULL::DOUBLE,
         []::STRUCT(k VARCHAR, t BIGINT, src BIGINT)[], []::STRUCT(k VARCHAR, t BIGINT, src BIGINT, q BIGINT, f BIGINT)[] FROM ln
  UNION ALL
  SELECT part, i, rid, outcome, source, CASE WHEN outcome = 'semantic_hit' THEN -best.s END,
         CASE WHEN outcome IN ('miss', 'semantic_hit') OR op = 'set' AND layer <> 'semantic' THEN list_append(ex1, {{'k': ek, 't': t, 'src': coalesce(source, rid)}})
              WHEN op = 'delete' AND layer <> 'semantic' THEN ex1 ELSE ex0 END,
         CASE WHEN outcome = 'miss' OR op = 'set' AND layer <> 'exact' THEN list_append(se1, {{'k': sk, 't': t, 'src': rid, 'q': q, 'f': f}})
              WHEN op = 'delete' AND layer <> 'exact' THEN se1 ELSE se0 END
  FROM (SELECT *, CASE outcome WHEN 'exact_hit' THEN hit.src WHEN 'semantic_hit' THEN best.src WHEN 'miss' THEN rid END AS source
        FROM (SELECT *, CASE WHEN op <> 'get' THEN NULL WHEN hit IS NOT NULL THEN 'exact_hit'
                             WHEN best IS NOT NULL AND -best.s >= 0.9 AND same[best.q] THEN 'semantic_hit' ELSE 'miss' END AS outcome
              FROM (SELECT l.part, l.i, l.rid, l.t, l.op, l.layer, l.q, l.f, l.ek, l.sk, l.same, w.ex AS ex0, w.se AS se0,
                           {found} AS hit, {cand} AS best,
                           {keep.format(col='w.ex', key='l.ek')} AS ex1, {keep.format(col='w.se', key='l.sk')} AS se1
                    FROM lwalk w JOIN ln l ON l.part = w.part AND l.i = w.i + 1))))"""


def sql_cache_layers() -> str:
    return "WITH RECURSIVE " + _layer_ctes() + """
SELECT rid AS event_id, outcome, source AS source_event, round(sim, 6) AS similarity FROM lwalk WHERE outcome IS NOT NULL"""


def sql_cache_answers() -> str:
    asked = "SELECT qid AS query_id, query AS text FROM lasked"
    missed = """,
lmiss AS MATERIALIZED (SELECT w.rid, w.outcome, w.source, lg.query, CASE WHEN lg.f = 2 THEN 'de' END AS category
                       FROM lwalk w JOIN lg USING (rid) WHERE w.outcome IS NOT NULL),
lasked AS MATERIALIZED (SELECT query, category, min(rid) AS qid FROM lmiss WHERE outcome = 'miss' GROUP BY ALL),"""
    filters = "qf AS (SELECT qid AS query_id, NULL::VARCHAR AS product, category FROM lasked)"
    body = sql_hybrid_retrieval(queries=asked, filters=filters).removeprefix("WITH RECURSIVE ")
    head, tail = body.rsplit("SELECT query_id, node_id, rank2 AS rank", 1)
    return "WITH RECURSIVE " + _layer_ctes(plain=True) + missed + head + ",\nlbest AS (SELECT query_id, node_id, rank2 AS rank" + tail + f"""),
lans AS (SELECT m.rid, b.node_id::VARCHAR AS answer FROM lmiss m
         JOIN lasked a ON a.query = m.query AND a.category IS NOT DISTINCT FROM m.category
         JOIN lbest b ON b.query_id = a.qid AND b.rank = 1 WHERE m.outcome = 'miss'
         UNION ALL SELECT rid, 'resp-' || rid FROM lg WHERE op = 'set')
SELECT m.rid AS event_id, m.outcome, coalesce(lans.answer, 'no answer') AS response
FROM lmiss m LEFT JOIN lans ON lans.rid = m.source"""


def sql_semantic_cache_lookup() -> str:
    return f"""
WITH best AS (SELECT q.vec_id, c.vec_id AS cached_id, {dot('q.embedding', 'c.embedding')} AS sim
              FROM embeddings q JOIN embeddings c ON c.label = q.label AND c.vec_id <> q.vec_id
              QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY round(sim, 9) DESC, c.vec_id) = 1)
SELECT e.vec_id, b.cached_id, round(b.sim, 6) AS similarity, coalesce(b.sim >= {SEM_THRESHOLD}, false) AS hit
FROM embeddings e LEFT JOIN best b USING (vec_id)"""


def sql_judge_pairs() -> str:
    ts = lambda c: f"list_sort(list_distinct({terms(c)}))"
    return f"""
SELECT u.conv_id, u.turn, {ts('u.text')} = {ts('p.text')} AS match,
       CASE WHEN {ts('u.text')} = {ts('p.text')} THEN 'same terms' ELSE 'different terms' END AS reason
FROM conversations u JOIN conversations p ON p.conv_id = u.conv_id AND p.turn = u.turn - 2"""


def sql_judge_verdicts() -> str:
    return """
SELECT role, count(*) FILTER (WHERE (conv_id + turn) % 5 <> 2)::BIGINT AS n_verdicts,
       count(*) FILTER (WHERE (conv_id + turn) % 5 > 2 AND turn % 2 = 0)::BIGINT AS n_match,
       count(*) FILTER (WHERE (conv_id + turn) % 5 < 2)::BIGINT AS n_malformed
FROM conversations GROUP BY role"""


def sql_rerank_top5() -> str:
    return "WITH " + fused_ctes() + f""",
sc AS (SELECT f.query_id, f.node_id, f.rank,
              CASE WHEN len(list_distinct({terms('b.text')})) > 0
                   THEN len(list_intersect(list_distinct({terms('b.text')}), {terms('d.text')}))::DOUBLE
                        / len(list_distinct({terms('b.text')})) ELSE 0.0 END AS s
       FROM fused f JOIN documents d ON d.doc_id = f.node_id JOIN benchmark b ON b.item_id = f.query_id)
SELECT query_id, node_id, rank2 AS rank, round(s, 6) AS score FROM (
  SELECT query_id, node_id, s, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, rank, node_id) AS rank2
  FROM sc) WHERE rank2 <= 5"""


def sql_hybrid_retrieval(pre: bool = False, queries: str = "SELECT item_id AS query_id, text FROM benchmark",
                         filters: str | None = None) -> str:
    """H5 end to end: PRF variants, hashed-vector and BM25 top-50 per variant,
    relative fusion over 3 variants, filter, cutoff, per-query exact / near /
    semantic dedup (greedy walks over (query, node) keys), re-rank top 5."""
    key = "query_id * 1048576 + node_id"

    def _match(qid: str, nid: str) -> str:
        return (f"EXISTS (SELECT 1 FROM documents pd LEFT JOIN qf pq ON pq.query_id = {qid} "
                f"WHERE pd.doc_id = {nid} AND (pq.product IS NULL OR coalesce(pd.source = pq.product, false)) "
                f"AND (pq.category IS NULL OR coalesce(pd.lang = pq.category, false)))")

    def _pre_join(q: str, t: str) -> str:
        return f" WHERE {_match(q + '.query_id', t + '.node_id')}" if pre else ""

    def _pre_where(qid: str, nid: str) -> str:
        return f"WHERE {_match(qid, nid)}" if pre else ""
    return "WITH RECURSIVE " + bm25_ctes(10, queries) + f""",
{filters or _bench_filters()},
fb AS (SELECT bm.query_id, tf.term, sum(tf.tf * idf.idf) AS w
       FROM bm JOIN tf ON tf.node_id = bm.node_id JOIN idf ON idf.term = tf.term GROUP BY ALL),
ex AS (SELECT * FROM fb WHERE NOT EXISTS (SELECT 1 FROM qt WHERE qt.query_id = fb.query_id AND qt.term = fb.term)),
rk AS (SELECT query_id, term, row_number() OVER (PARTITION BY query_id ORDER BY round(w, 9) DESC, term) AS v
       FROM ex QUALIFY v <= 2),
variants AS (SELECT query_id, 0 AS variant_no, text FROM bq
             UNION ALL SELECT rk.query_id, rk.v, bq.text || ' ' || rk.term FROM rk JOIN bq USING (query_id)),
vqt AS (SELECT DISTINCT query_id, variant_no, unnest(list_distinct({terms('text')})) AS term FROM variants),
vbm AS (SELECT query_id, variant_no, node_id, score FROM (
          SELECT vqt.query_id, vqt.variant_no, tf.node_id,
                 sum(idf.idf * tf.tf * 2.5 / (tf.tf + 1.5 * (0.25 + 0.75 * tf.dl / (SELECT avgdl FROM stats)))) AS score
          FROM vqt JOIN tf USING (term) JOIN idf USING (term){_pre_join('vqt', 'tf')} GROUP BY ALL)
        WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY query_id, variant_no ORDER BY round(score, 9) DESC, node_id) <= 50),
{hashed_ctes("SELECT doc_id AS id, text FROM documents", 64, "hd")},
{hashed_ctes("SELECT query_id * 1024 + variant_no AS id, text FROM variants", 64, "hq")},
vec AS (SELECT qv // 1024 AS query_id, qv % 1024 AS variant_no, node_id, score FROM (
          SELECT q.id AS qv, d.id AS node_id, {dot('q.v', 'd.v')} AS score FROM hq_dense q, hd_dense d
          {_pre_where('q.id // 1024', 'd.id')})
        QUALIFY row_number() OVER (PARTITION BY qv ORDER BY round(score, 9) DESC, node_id) <= 50),
lists AS (SELECT query_id, variant_no, node_id, score, 'v' AS r, 0.75 AS w FROM vec
          UNION ALL SELECT query_id, variant_no, node_id, score, 'b' AS r, 0.25 AS w FROM vbm),
scaled AS (SELECT *, min(score) OVER (PARTITION BY query_id, variant_no, r) AS lo,
                     max(score) OVER (PARTITION BY query_id, variant_no, r) AS hi FROM lists),
fsum AS (SELECT query_id, node_id,
                sum(CASE WHEN hi = lo THEN (CASE WHEN hi > 0 THEN 1.0 ELSE 0.0 END)
                         ELSE (score - lo) / (hi - lo) END * w / 3) AS score
         FROM scaled GROUP BY ALL),
fused AS (SELECT query_id, node_id, score,
                 row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, node_id) AS rank
          FROM fsum QUALIFY rank <= 50),
flt AS (SELECT f.query_id, f.node_id, f.rank, f.score, d.text
        FROM fused f JOIN documents d ON d.doc_id = f.node_id LEFT JOIN qf ON qf.query_id = f.query_id
        WHERE (qf.product IS NULL OR coalesce(d.source = qf.product, false))
          AND (qf.category IS NULL OR coalesce(d.lang = qf.category, false)) AND f.score >= 0.6),
ex1 AS (SELECT * FROM (SELECT *, sha256({norm_dedup('text')}) AS fp FROM flt)
        QUALIFY row_number() OVER (PARTITION BY query_id, fp ORDER BY round(score, 9) DESC, node_id) = 1),
{minhash_ctes("SELECT DISTINCT node_id AS id, text FROM ex1")},
nb AS (SELECT e.query_id, e.node_id AS id, g.s, unnest(generate_series(0, {BANDS - 1})) AS band
       FROM ex1 e JOIN sigl g ON g.id = e.node_id),
ncand AS (SELECT DISTINCT x.query_id, x.id AS a, y.id AS b, x.s AS sa, y.s AS sb
          FROM nb x JOIN nb y ON x.query_id = y.query_id AND x.band = y.band
            AND x.s[x.band * {ROWS} + 1 : x.band * {ROWS} + {ROWS}] = y.s[y.band * {ROWS} + 1 : y.band * {ROWS} + {ROWS}]
          WHERE x.id < y.id),
nedge AS (SELECT query_id * 1048576 + a AS a, query_id * 1048576 + b AS b FROM ncand
          WHERE list_sum(list_transform(generate_series(1, {NUM_PERM}), lambda i: (sa[i] = sb[i])::INT)) / {NUM_PERM}.0 >= 0.9),
nrank AS (SELECT {key} AS id, row_number() OVER (ORDER BY query_id, round(score, 9) DESC, node_id) AS pos FROM ex1)"""\
        + greedy_ctes("nd", "SELECT a, b FROM nedge", "SELECT id, pos FROM nrank") + f""",
n2 AS (SELECT * FROM ex1 WHERE {key} NOT IN (SELECT id FROM nd_dropped)),
spairs AS (SELECT x.query_id * 1048576 + x.node_id AS a, y.query_id * 1048576 + y.node_id AS b
           FROM n2 x JOIN n2 y ON x.query_id = y.query_id AND x.node_id < y.node_id
           JOIN hd_dense dx ON dx.id = x.node_id JOIN hd_dense dy ON dy.id = y.node_id
           WHERE {dot('dx.v', 'dy.v')} >= 0.9),
srank AS (SELECT {key} AS id, row_number() OVER (ORDER BY query_id, round(score, 9) DESC, node_id) AS pos FROM n2)"""\
        + greedy_ctes("sd", "SELECT a, b FROM spairs", "SELECT id, pos FROM srank") + f""",
n3 AS (SELECT * FROM n2 WHERE {key} NOT IN (SELECT id FROM sd_dropped)),
rr AS (SELECT n3.query_id, n3.node_id, n3.rank,
              CASE WHEN len(list_distinct({terms('b.text')})) > 0
                   THEN len(list_intersect(list_distinct({terms('b.text')}), {terms('n3.text')}))::DOUBLE
                        / len(list_distinct({terms('b.text')})) ELSE 0.0 END AS s
       FROM n3 JOIN bq b ON b.query_id = n3.query_id)
SELECT query_id, node_id, rank2 AS rank, round(s, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, rank, node_id) AS rank2 FROM rr)
WHERE rank2 <= 5"""


def sql_hybrid_chunks() -> str:
    """The hybrid plan with windows of words in place of documents, numbered densely inside."""
    body = sql_hybrid_retrieval(filters="qf AS (SELECT * FROM asked_for)").removeprefix("WITH RECURSIVE ")
    body = body.replace("FROM documents", "FROM chunked").replace("JOIN documents", "JOIN chunked")
    head, tail = body.rsplit("SELECT query_id, node_id, rank2 AS rank", 1)
    return f"""WITH RECURSIVE windows AS ({sql_chunk_windows()}),
chunked AS MATERIALIZED (SELECT row_number() OVER (ORDER BY w.node_id) AS doc_id, w.node_id AS real_id, w.text, d.source, d.lang
                         FROM windows w JOIN documents d ON d.doc_id = w.doc_id),
{_bench_filters().replace('qf AS', 'asked_for AS')},
""" + head.lstrip() + ",\nbest AS (SELECT query_id, node_id, rank2 AS rank" + tail + """)
SELECT b.query_id, c.real_id AS node_id, b.rank, b.score FROM best b JOIN chunked c ON c.doc_id = b.node_id"""


ORACLE = {
    "vector_topk": sql_vector_topk,
    "bm25_topk": sql_bm25_topk,
    "fusion_relative": lambda: sql_fusion("relative"),
    "fusion_rrf": lambda: sql_fusion("rrf"),
    "metadata_filter": sql_metadata_filter,
    "score_cutoff": sql_score_cutoff,
    "query_variants": sql_query_variants,
    "exact_dedup": sql_exact_dedup,
    "shingles": sql_shingles,
    "minhash_signature": sql_minhash_signature,
    "lsh_candidates": sql_lsh_candidates,
    "near_dup_pairs": sql_near_dup_pairs,
    "near_dedup": sql_near_dedup,
    "semantic_pairs": sql_semantic_pairs,
    "semantic_dedup": sql_semantic_dedup,
    "dedup_chain": sql_dedup_chain,
    "rerank_top5": sql_rerank_top5,
    "hybrid_retrieval": sql_hybrid_retrieval,
    "hybrid_retrieval_index": sql_hybrid_retrieval,
    "hybrid_retrieval_pre": lambda: sql_hybrid_retrieval(pre=True),
    "tokenize": sql_tokenize,
    "chunk_windows": sql_chunk_windows,
    "flatten_articles": sql_flatten_articles,
    "read_articles": sql_flatten_articles,
    "hybrid_retrieval_chunks": sql_hybrid_chunks,
    "corpus_build": sql_corpus_build,
    "embed_hashed": sql_embed_hashed,
    "l2_normalize": sql_l2_normalize,
    "validate_embeddings": sql_validate_embeddings,
    "active_chunks": sql_active_chunks,
    "ivf_assign": sql_ivf_assign,
    "ivf_probe": sql_ivf_probe,
    "ivf_add": sql_ivf_probe,
    "pq_encode": sql_pq_encode,
    "pq_train": sql_pq_train,
    "pq_search": sql_pq_search,
    "cache_key_exact": sql_cache_key_exact,
    "cache_key_semantic": sql_cache_key_semantic,
    "cache_get_asof": sql_cache_get_asof,
    "cache_put_delete": sql_cache_put_delete,
    "cache_ttl_replay": sql_cache_ttl_replay,
    "cache_outcomes": sql_cache_outcomes,
    "semantic_cache_lookup": sql_semantic_cache_lookup,
    "judge_pairs": sql_judge_pairs,
    "judge_verdicts": sql_judge_verdicts,
    "cache_stream": sql_cache_two_layer,
    "cache_replay": sql_cache_two_layer,
    "cache_fill": sql_cache_fill,
    "cache_two_layer": sql_cache_layers,
    "cache_answers": sql_cache_answers,
}


def oracle_sql() -> dict[str, str]:
    return {k: f().strip() for k, f in ORACLE.items()}
