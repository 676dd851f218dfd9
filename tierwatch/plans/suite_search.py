"""Registered queries: vector, lexical and hybrid search."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tierwatch.constants import BM25_B, BM25_K1
from tierwatch.functions.embedding import embed_literal
from tierwatch.operators import lexical_search, similar_rows as similar, vector_search as vs
from tierwatch.operators.hybrid_search import hybrid_scan_search
from tierwatch.operators.investigation import restrict
from tierwatch.operators.search_index import SearchIndex, search_request as build_request
from tierwatch.operators.vector_index import VectorIndex
from tierwatch.plans import standins as s
from tierwatch.plans.registered import query
from tierwatch.session import scratch_path

QUERY_TEXT = "license copyright idiot that with this"
TERMS = QUERY_TEXT.split()

_COS = "round(list_cosine_similarity(a.embedding::DOUBLE[], q.embedding::DOUBLE[]), 10)"


def _top(scores: str, k: int) -> str:
    return f"""
SELECT vec_id, round(score, 3) AS similarity, rank::INTEGER AS rank FROM (
  SELECT vec_id, score, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM ({scores}) s) r WHERE rank <= {k}"""


def _vectors(spark, sf_dir):
    return s.table(spark, sf_dir, "embeddings")


def _query_vector(spark, sf_dir):
    """The vector of row 0 serves as the question."""
    return _vectors(spark, sf_dir).filter("vec_id = 0").first()["embedding"]


@query(_top(f"SELECT a.vec_id, {_COS} AS score FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 0) q", 10))
def vector_search(spark, sf_dir):
    return vs.vector_search(_vectors(spark, sf_dir), _query_vector(spark, sf_dir), 10, "vec_id")


@query(_top(f"""SELECT a.vec_id, {_COS} AS score FROM embeddings a,
  (SELECT embedding FROM embeddings WHERE vec_id = 0) q WHERE a.label = 3""", 10))
def vector_search_filtered(spark, sf_dir):
    return vs.vector_search(_vectors(spark, sf_dir), _query_vector(spark, sf_dir), 10, "vec_id", filter_eq={"label": 3})


@query(_top(f"""SELECT a.vec_id, {_COS} AS score FROM embeddings a,
  (SELECT embedding FROM embeddings WHERE vec_id = 1) q WHERE a.vec_id <> 1""", 5))
def more_like(spark, sf_dir):
    return vs.more_like(_vectors(spark, sf_dir), 1, 5, "vec_id")


_MANY = f"""
SELECT query_id, vec_id, round(score, 3) AS similarity, rank::INTEGER AS rank FROM (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
    SELECT q.vec_id AS query_id, a.vec_id, {_COS} AS score FROM embeddings a JOIN embeddings q ON a.vec_id <> q.vec_id) s) r
WHERE rank <= 3"""


@query(_MANY)
def more_like_each(spark, sf_dir):
    """Nearest rows of every row, with the queries sent to each task."""
    vectors = _vectors(spark, sf_dir)
    return vs.vector_search_many(vectors, vectors, 3, "vec_id", "vec_id", exclude_self=True)


@query(_MANY)
def more_like_each_grid(spark, sf_dir):
    """The same in several passes, as for more queries than one pass takes."""
    vectors = _vectors(spark, sf_dir)
    return vs.vector_search_many(vectors, vectors, 3, "vec_id", "vec_id", exclude_self=True, query_block=200)


def _recall(spark, sf_dir, find):
    """Approximate nearest rows of every row, held against the exact ones of the rows whose id is divisible by 20."""
    vectors = _vectors(spark, sf_dir)
    found = find(vectors, 3, "vec_id")
    asked = vectors.filter("vec_id % 20 = 0")
    exact = vs.vector_search_many(vectors, asked, 3, "vec_id", "vec_id", exclude_self=True)
    exact = exact.select("query_id", "vec_id", F.col("similarity").alias("wanted"))
    wanted, hit = F.col("wanted").isNotNull(), F.col("similarity").isNotNull()
    return exact.join(found, ["query_id", "vec_id"], "full").agg(
        F.countDistinct(F.when(wanted, F.col("query_id"))).alias("n_queries"), F.count("wanted").alias("n_wanted"),
        (F.count_if(wanted & hit) >= 0.9 * F.count("wanted")).alias("recall_is_enough"),
        F.count_if(F.abs(F.col("similarity") - F.col("wanted")) > 1e-9).alias("n_wrong_scores"),
        F.countDistinct(F.when(hit, F.col("query_id"))).alias("n_rows"), F.count("similarity").alias("n_found"),
        F.sum("rank").alias("rank_sum"), F.count_if(hit & (F.col("query_id") == F.col("vec_id"))).alias("n_selves"))


_RECALL = """
SELECT count(*) FILTER (vec_id % 20 = 0) AS n_queries, 3 * count(*) FILTER (vec_id % 20 = 0) AS n_wanted, TRUE AS recall_is_enough,
       0::BIGINT AS n_wrong_scores, count(*) AS n_rows, 3 * count(*) AS n_found, 6 * count(*) AS rank_sum, 0::BIGINT AS n_selves
FROM embeddings"""


@query(_RECALL)
def more_like_graph(spark, sf_dir):
    """Nearest rows of every row by a neighbour graph."""
    return _recall(spark, sf_dir, similar.more_like_graph)


@query(_RECALL)
def more_like_lsh(spark, sf_dir):
    """Nearest rows of every row by hash buckets."""
    return _recall(spark, sf_dir, similar.more_like_lsh)


@query("""
SELECT count(*) AS n_queries, 3 * count(*) AS n_wanted, TRUE AS recall_is_enough, 0::BIGINT AS n_not_exact, 3 * count(*) AS n_of_all_cells
FROM embeddings WHERE vec_id % 20 = 0""")
def vector_index_search(spark, sf_dir):
    """A stored vector index: nine in ten of the nearest rows from half of the cells, all of them from all cells."""
    vectors = _vectors(spark, sf_dir)
    index = VectorIndex(scratch_path(spark, "vectors"), "vec_id", cells=16)
    index.build(vectors)
    asked = vectors.filter("vec_id % 20 = 0")
    exact = vs.vector_search_many(vectors, asked, 3, "vec_id", "vec_id", exclude_self=True)
    some, every = (index.search_many(asked, 4, "vec_id", probes=p, rescored=r, exclude_self=True, most_questions=None).filter("rank <= 3")
                   .select("query_id", "vec_id", F.col("rank").alias(name), F.col("similarity").alias(f"{name}_similarity"))
                   for p, r, name in ((11, 60, "found"), (16, None, "all_cells")))
    met = exact.join(some, ["query_id", "vec_id"], "left").join(every, ["query_id", "vec_id"], "left")
    same = (F.col("rank") == F.col("all_cells")) & (F.col("similarity") == F.col("all_cells_similarity"))
    return met.agg(F.countDistinct("query_id").alias("n_queries"), F.count("*").alias("n_wanted"),
                   (F.count("found") >= 0.9 * F.count("*")).alias("recall_is_enough"),
                   F.count_if((F.col("found_similarity") != F.col("similarity")) | ~same).alias("n_not_exact"),
                   F.count("all_cells").alias("n_of_all_cells"))


_TEXT = "subject || ' ' || body"


@query(f"""
WITH {s.SQL_DOCUMENTS}, {s.sql_cells("docs", _TEXT)}
SELECT d.email_id, d.sender_dept, count(c.b) AS places, coalesce(sum(c.c), 0)::DOUBLE AS words
FROM docs d LEFT JOIN cells c USING (email_id) GROUP BY 1, 2""")
def text_vectors(spark, sf_dir):
    vectors = vs.build_vectors(s.documents(spark, sf_dir), "email_id", "subject", "body", ["sender_dept"])
    return vectors.select(
        "email_id", "sender_dept",
        F.size(F.filter("embedding", lambda x: x > 0)).cast("long").alias("places"),
        F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")).alias("words"))


_QUERY_CELLS = f"""
query_cells AS (SELECT {s.CELL} AS b, count(*)::DOUBLE AS c FROM (VALUES {", ".join(f"('{t}')" for t in TERMS)}) v(w) GROUP BY 1),
vector_scores AS (
  SELECT x.email_id, round(coalesce(sum(x.c * q.c), 0) / (sqrt(sum(x.c * x.c)) * (SELECT sqrt(sum(c * c)) FROM query_cells)), 10) AS score
  FROM cells x LEFT JOIN query_cells q USING (b) GROUP BY 1),
all_vectors AS (SELECT d.email_id, d.sender_dept, coalesce(v.score, 0.0) AS score FROM docs d LEFT JOIN vector_scores v USING (email_id))"""
_VECTORS_SQL = f"{s.SQL_DOCUMENTS}, {s.sql_cells('docs', _TEXT)}, {_QUERY_CELLS}"


@query(f"""
WITH {_VECTORS_SQL}
SELECT email_id, round(score, 3) AS similarity, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (ORDER BY score DESC, email_id) AS rank FROM all_vectors) r WHERE rank <= 3""")
def text_search(spark, sf_dir):
    """A question in words against the vectors of the messages."""
    vectors = vs.build_vectors(s.documents(spark, sf_dir), "email_id", "subject", "body")
    return vs.vector_search(vectors, embed_literal(QUERY_TEXT), 3, "email_id")


def _bm25(where: str = "TRUE") -> str:
    terms = ", ".join(f"('{t}')" for t in sorted(set(TERMS)))
    return f"""
tok AS (SELECT email_id, w FROM (
  SELECT email_id, unnest(string_split_regex(lower(body), '{s.SEPARATOR}')) AS w FROM docs) t WHERE w <> ''),
lens AS (SELECT d.email_id, d.sender_dept, d.sent_at, count(t.w) AS dl FROM docs d LEFT JOIN tok t USING (email_id) GROUP BY ALL),
tf AS (SELECT email_id, w, count(*) AS tf FROM tok WHERE w IN (SELECT * FROM (VALUES {terms})) GROUP BY 1, 2),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY 1),
st AS (SELECT count(*) AS n, avg(dl) AS adl FROM lens),
bm25 AS (
  SELECT tf.email_id, round(sum(ln(1 + (st.n - df.df + 0.5) / (df.df + 0.5)) * tf.tf * ({BM25_K1}::DOUBLE + 1)
         / (tf.tf + {BM25_K1}::DOUBLE * (1 - {BM25_B}::DOUBLE + {BM25_B}::DOUBLE * lens.dl / st.adl))), 10) AS score
  FROM tf JOIN df USING (w) JOIN lens USING (email_id), st WHERE {where} GROUP BY 1)"""


def _ranked(source: str, k: int) -> str:
    return f"""
SELECT email_id, round(score, 6) AS score, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (ORDER BY score DESC, email_id) AS rank FROM {source}) r WHERE rank <= {k}"""


@query(f"WITH {s.SQL_DOCUMENTS}, {_bm25()} {_ranked('bm25', 20)}")
def bm25_search(spark, sf_dir):
    return lexical_search.bm25_search(s.documents(spark, sf_dir), "email_id", "body", QUERY_TEXT, 20)


@query(f"""WITH {s.SQL_DOCUMENTS}, {_bm25("lens.sender_dept = 'de'")} {_ranked('bm25', 5)}""")
def bm25_search_filtered(spark, sf_dir):
    return lexical_search.bm25_search(s.documents(spark, sf_dir), "email_id", "body", QUERY_TEXT, 5,
                                      filter_eq={"sender_dept": "de"})


def _index(spark, sf_dir) -> SearchIndex:
    index = SearchIndex(scratch_path(spark, "search"), "messages", "email_id", "body", "subject", ["sender_dept"],
                        buckets=8)
    index.refresh(s.documents(spark, sf_dir), 0)
    return index


@query(f"WITH {s.SQL_DOCUMENTS}, {_bm25()} {_ranked('bm25', 20)}")
def index_search(spark, sf_dir):
    """The lexical ranking from a stored index."""
    return _index(spark, sf_dir).lexical_search(spark, QUERY_TEXT, 20)


_CHANGED = "CASE WHEN email_id % 2 = 0 THEN body ELSE subject END"


@query(f"""
WITH all_docs AS (WITH {s.SQL_DOCUMENTS} SELECT * FROM docs),
docs AS (SELECT * REPLACE ({_CHANGED} AS body) FROM all_docs WHERE email_id % 7 <> 0),
{_bm25()} {_ranked('bm25', 20)}""")
def index_changed_messages(spark, sf_dir):
    """All messages by their subjects, then half of them by their bodies; some are deleted, and the rest is compacted between."""
    messages = s.documents(spark, sf_dir)
    index = SearchIndex(scratch_path(spark, "search"), "messages", "email_id", "body", "subject", ["sender_dept"], buckets=8)
    index.refresh(messages.withColumn("body", F.col("subject")), 0)
    index.delete(messages.filter("email_id % 7 = 0"), 0)
    index.compact(spark)
    index.refresh(messages.filter("email_id % 2 = 0 AND email_id % 7 <> 0"), 1)
    return index.lexical_search(spark, QUERY_TEXT, 20)


def _fused(where: str = "TRUE", vector_where: str = "TRUE", k: int = 5) -> str:
    return f"""
WITH {_VECTORS_SQL}, {_bm25(where)},
lex AS (SELECT email_id, row_number() OVER (ORDER BY score DESC, email_id) AS r FROM bm25),
vec AS (SELECT email_id, row_number() OVER (ORDER BY score DESC, email_id) AS r FROM all_vectors WHERE {vector_where}),
fused AS (
  SELECT email_id, lex.r AS lr, vec.r AS vr,
         round(coalesce(1.0::DOUBLE / (60 + lex.r), 0) + coalesce(1.0::DOUBLE / (60 + vec.r), 0), 12) AS points
  FROM lex FULL JOIN vec USING (email_id)),
best AS (SELECT *, row_number() OVER (ORDER BY points DESC, email_id) AS rank FROM fused)
SELECT email_id, lr::INTEGER AS lexical_rank, vr::INTEGER AS vector_rank, round(points, 6) AS score, rank::INTEGER AS rank
FROM best WHERE rank <= {k}"""


@query(_fused())
def hybrid_search(spark, sf_dir):
    """Words and vectors fused by rank, straight from the message table."""
    return hybrid_scan_search(s.documents(spark, sf_dir), "email_id", "subject", "body", QUERY_TEXT, 5)


@query(_fused(k=20))
def hybrid_index_search(spark, sf_dir):
    return _index(spark, sf_dir).search(spark, QUERY_TEXT, 20)


@query(_fused("lens.sender_dept = 'de'", "sender_dept = 'de'").replace(
    "SELECT email_id, lr", "SELECT email_id, subject, substr(body, 1, 300) AS body, sender_dept, lr", 1).replace(
    "FROM best WHERE", "FROM best JOIN docs USING (email_id) WHERE", 1))
def search_request(spark, sf_dir):
    """A request with columns, filter and limit, as JSON, against a stored index."""
    messages = s.documents(spark, sf_dir)
    index = _index(spark, sf_dir)
    request = build_request(QUERY_TEXT, ["email_id", "subject", "body", "sender_dept"], 5, {"sender_dept": "de"})
    return index.answer(messages, request).withColumn("body", F.substring("body", 1, 300))


_SPAN = "sent_at >= TIMESTAMP '2024-01-01 02:00:00' AND sent_at < TIMESTAMP '2024-01-01 14:00:00'"


@query(f"""
WITH all_docs AS (WITH {s.SQL_DOCUMENTS} SELECT * FROM docs),
docs AS (SELECT * FROM all_docs WHERE {_SPAN} AND sender_dept = 'en' AND regexp_matches(lower(body), 'license|hate')),
{_bm25()} {_ranked('bm25', 10)}""")
def investigation(spark, sf_dir):
    """Search within a time span, a department and messages with a given word."""
    kept = restrict(s.documents(spark, sf_dir), since=datetime(2024, 1, 1, 2), until=datetime(2024, 1, 1, 14),
                    filter_eq={"sender_dept": "en"}, words=["license", "hate"])
    return lexical_search.bm25_search(kept, "email_id", "body", QUERY_TEXT, 10)
