import hashlib
import math
import random
import re
from collections import Counter
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierwatch.functions import embedding
from tierwatch.functions.digests import first_of_md5
from tierwatch.functions.embedding import embed_literal
from tierwatch.operators import lexical_search, postings, search_index, similar_rows as lsh, vector_search as vs
from tierwatch.operators.hybrid_search import fuse
from tierwatch.operators.investigation import restrict
from tierwatch.operators.search_index import SearchIndex, list_indexes
from tierwatch.operators.vector_index import VectorIndex
from tierwatch.session import create_text, file_names, read_text

WORDS = "merger tip report meeting fund trade desk price quiet delete".split()


def texts(n=120, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of all texts are copies of one another.
        body = "merger tip quiet" if i % 3 == 0 else " ".join(rng.choices(WORDS, k=rng.randrange(1, 12)))
        rows.append((f"m{i:03d}", f"s{i % 4}", body, rng.choice(["Research", "Trading"])))
    return rows + [("z1", "s", "", "Research"), ("z2", "s", None, "Research")]


@pytest.fixture
def corpus(spark):
    return spark.createDataFrame(texts(), "id string, subject string, body string, dept string").repartition(5)


def brute_bm25(rows, query, keep=lambda r: True):
    docs = {r[0]: re.findall(r"[a-z0-9]+", r[2].lower()) for r in rows if r[2] is not None}
    mean = sum(map(len, docs.values())) / len(docs)
    terms = sorted(set(query.lower().split()))
    df = {t: sum(t in d for d in docs.values()) for t in terms}
    scores = {}
    for r in rows:
        if r[0] not in docs or not keep(r):
            continue
        tf, total = Counter(docs[r[0]]), 0.0
        for t in terms:
            idf = math.log(1 + (len(docs) - df[t] + 0.5) / (df[t] + 0.5))
            total += idf * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(docs[r[0]]) / mean))
        if total > 0:
            scores[r[0]] = round(total, 10)
    return scores


def ranked(scores):
    return sorted(scores, key=lambda i: (-scores[i], i))


@pytest.mark.parametrize("query", ["merger tip", "quiet quiet desk", "it's absent", "", "price"])
def test_bm25_scan_and_index_agree_with_brute_force(spark, corpus, folder, query):
    index = SearchIndex(folder, "messages", "id", "body", "subject", ["dept"], buckets=4)
    for part in range(3):  # three batches
        index.refresh(corpus.filter(F.pmod(F.xxhash64("id"), F.lit(3)) == part), part)
    expected = brute_bm25(texts(), query)
    only = brute_bm25(texts(), query, lambda r: r[3] == "Research")
    for where, wanted in ((None, expected), ({"dept": "Research"}, only)):
        scan = lexical_search.bm25_scores(corpus, "id", "body", query, where)
        stored = index.lexical_scores(spark, query, where)
        for found in (scan, stored):
            assert {r["id"]: r["score"] for r in found.collect()} == pytest.approx(wanted, abs=1e-9)
    top = [r["id"] for r in lexical_search.bm25_search(corpus, "id", "body", query, 7).collect()]
    assert top == ranked(expected)[:7]


def brute_fused(lexical, vector, k, constant):
    points = {}
    for scores in (lexical, vector):
        for rank, i in enumerate(ranked(scores), 1):
            points[i] = points.get(i, 0) + 1 / (constant + rank)
    return ranked({i: round(p, 12) for i, p in points.items()})[:k]


@pytest.mark.parametrize("k,constant,seed", [(1, 1, 0), (3, 2, 1), (5, 5, 2), (10, 60, 3), (500, 60, 4)])
def test_fusion_equals_full_rankings(spark, k, constant, seed):
    """Opposed rankings with many ties: candidates of one list sit deep in the other."""
    rng = random.Random(seed)
    vector = {i: round(rng.random(), 2) for i in range(400)}
    lexical = {i: round(1 - vector[i] + rng.random() * 0.3, 1) for i in range(400) if rng.random() < 0.6}
    frames = [spark.createDataFrame(list(s.items()), "id int, score double") for s in (lexical, vector)]
    found = fuse(*frames, "id", k, constant).orderBy("rank").collect()
    assert [r["id"] for r in found] == brute_fused(lexical, vector, k, constant)
    places = {i: n for n, i in enumerate(ranked(lexical), 1)}
    assert all(r["lexical_rank"] == places.get(r["id"]) for r in found)


def test_fusion_of_nothing(spark):
    empty = spark.createDataFrame([], "id int, score double")
    assert fuse(empty, empty, "id", 3).count() == 0
    one = spark.createDataFrame([(1, 0.5)], "id int, score double")
    assert [r["id"] for r in fuse(empty, one, "id", 3).collect()] == [1]


def test_vector_search_edges(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [2.0, 0.0], "b"), (3, [0.0, 1.0], "a"), (4, None, "a"), (5, [1.0], "a"), (6, [0.0, 0.0], "a")]
    df = spark.createDataFrame(rows, "id int, embedding array<float>, tag string")
    found = vs.vector_search(df, [1.0, 0.0], 10, "id").orderBy("rank").collect()
    assert [(r["id"], r["similarity"], r["rank"]) for r in found] == [(1, 1.0, 1), (2, 1.0, 2), (3, 0.0, 3), (6, 0.0, 4)]
    assert vs.vector_search(df, [1.0, 0.0], 3, "id", filter_eq={"tag": "none"}).count() == 0
    assert [r["id"] for r in vs.more_like(df, 1, 1, "id").collect()] == [2]
    for missing in (4, 99):
        with pytest.raises(ValueError):
            vs.more_like(df, missing, 1, "id")


def test_vector_search_plan(spark, folder):
    spark.createDataFrame([(1, [1.0], "a", "text")], "id int, embedding array<float>, tag string, body string").write.parquet(folder + "/v")
    plan = vs.vector_search(spark.read.parquet(folder + "/v"), [1.0], 3, "id", filter_eq={"tag": "a"})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and "EqualTo(tag,a)" in text
    assert "body" not in text and text.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("query_block", [1000, 16])
def test_many_queries_against_brute_force(spark, query_block):
    """A third of the vectors are equal: ties must come out by key in one pass and in several."""
    rng = np.random.default_rng(3)
    vectors = {f"v{i:03d}": [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).round(3).tolist() for i in range(100)}
    vectors["zero"] = [0.0, 0.0, 0.0]
    df = spark.createDataFrame(list(vectors.items()), "id string, embedding array<float>").repartition(7)
    found = vs.vector_search_many(df, df, 4, "id", "id", exclude_self=True, query_block=query_block).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["id"])
    single = {i: np.asarray(v, np.float32).astype(np.float64) for i, v in vectors.items()}

    def cos(a, b):
        n = np.sqrt((a @ a) * (b @ b))
        return round(float(a @ b / n), 10) if n else 0.0

    for q in vectors:
        scores = {i: cos(single[q], single[i]) for i in vectors if i != q}
        assert got[q] == ranked(scores)[:4], q


def test_bad_queries_leave_the_others_alone(spark):
    corpus = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], "id int, embedding array<float>")
    asked = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, 1.0]), (3, [1.0, 2.0, 3.0]), (4, None), (None, [1.0, 1.0])],
                                  "q int, embedding array<float>")
    found = vs.vector_search_many(corpus, asked, 2, "id", "q").collect()
    assert sorted({r["q"] for r in found}) == [1, 2] and len(found) == 4
    assert sorted(r["q"] for r in vs.bad_queries(asked, 2).collect()) == [3, 4]


def test_build_vectors_takes_the_whole_body(spark):
    df = spark.createDataFrame([("1", "s", "word " * 400, "x")], "id string, subject string, body string, dept string")
    assert sum(vs.build_vectors(df, "id", "subject", "body").first()["embedding"]) == 401
    assert sum(vs.build_vectors(df, "id", "subject", "body", body_chars=1000).first()["embedding"]) == 201


def test_scan_and_index_agree_beyond_ascii(spark, folder):
    df = spark.createDataFrame([("1", "s", "ΟΔΟΣ one", "x"), ("2", "s", "İSTANBUL two", "x"), ("3", "s", "plain three", "y")],
                               "id string, subject string, body string, dept string")
    index = SearchIndex(folder, "m", "id", "body", "subject", ["dept"], buckets=4)
    index.refresh(df, 0)
    for word, wanted in (("ΟΔΟΣ", ["1"]), ("οδοσ", []), ("İSTANBUL", ["2"]), ("plain", ["3"])):
        scan = [r["id"] for r in lexical_search.bm25_search(df, "id", "body", word, 5).collect()]
        assert scan == [r["id"] for r in index.lexical_search(spark, word, 5).collect()]
        assert scan == wanted or word == "οδοσ"


def texts_of(index, spark, words="alpha beta gamma delta"):
    return {r["id"]: r["score"] for r in index.lexical_search(spark, words, 50).collect()}


def test_origins_changes_deletes_and_compaction(spark, folder):
    def batch(*rows):
        return spark.createDataFrame([(i, "s", t, d) for i, t, d in rows], "id string, subject string, body string, dept string")

    def fresh(name, *rows):
        made = SearchIndex(f"{folder}/{name}", "m", "id", "body", "subject", ["dept"], buckets=4)
        made.refresh(batch(*rows), 0)
        return made

    index = SearchIndex(folder, "m", "id", "body", "subject", ["dept"], buckets=4)
    index.refresh(batch(("1", "alpha", "x"), ("2", "beta beta", "y"), ("3", None, "x")), 0)
    index.refresh(batch(("4", "gamma", "x")), 0, origin="stream1")
    index.refresh(batch(("5", "delta", "y")), 0, origin="stream2")
    index.refresh(batch(("5", "delta delta", "y")), 0, origin="stream2")  # the same batch again
    assert texts_of(index, spark) == texts_of(fresh("a", ("1", "alpha", "x"), ("2", "beta beta", "y"), ("3", None, "x"),
                                                    ("4", "gamma", "x"), ("5", "delta delta", "y")), spark)
    index.refresh(batch(("2", "alpha gamma", "x"), ("6", "beta", "y")), 1)
    index.delete(batch(("4", None, None)), 0)
    wanted = fresh("b", ("1", "alpha", "x"), ("2", "alpha gamma", "x"), ("3", None, "x"), ("5", "delta delta", "y"), ("6", "beta", "y"))
    for _ in range(2):
        assert texts_of(index, spark) == texts_of(wanted, spark)
        assert sorted(r["id"] for r in index.vectors(spark).collect()) == ["1", "2", "3", "5", "6"]
        assert texts_of(wanted, spark, "alpha") == {r["id"]: r["score"] for r in index.lexical_search(
            spark, "alpha", 9, {"dept": "x"}).collect()}
        index.compact(spark)
    index.refresh(batch(("1", "delta", "x")), 2)
    assert texts_of(index, spark, "alpha").keys() == {"2"} and texts_of(index, spark, "delta").keys() == {"1", "5"}


MAIL = "id string, subject string, body string, dept string"


def mail(spark, *rows):
    return spark.createDataFrame([(i, "s", t, "x") for i, t in rows], MAIL)


def open_index(folder, **settings):
    return SearchIndex(folder, "m", "id", "body", "subject", ["dept"], **{"buckets": 4, **settings})


def inside(index, step, action):
    """Run ``action`` once while ``index`` is about to take a step."""
    real = getattr(index, step)

    def run(*args, **kwargs):
        setattr(index, step, real)
        action()
        return real(*args, **kwargs)

    setattr(index, step, run)


def check_live(index, spark, folder, **rows):
    """The index ranks as one that is built at once from the rows it should hold."""
    whole = open_index(f"{folder}/whole-{len(file_names(spark, folder))}")
    whole.refresh(mail(spark, *((i[1:], t) for i, t in rows.items())), 0)
    words = "apple cherry plum pear"
    assert texts_of(index, spark, words) == texts_of(whole, spark, words)
    assert sorted(r["id"] for r in index.vectors(spark).collect()) == sorted(i[1:] for i in rows)


@pytest.mark.parametrize("step", ["_write_postings", "_commit"])
def test_no_change_is_lost_beside_a_compaction(spark, folder, step):
    index, other = open_index(folder), open_index(folder)
    index.refresh(mail(spark, ("1", "apple"), ("2", "apple plum")), 0)
    inside(index, step, lambda: other.compact(spark))
    index.refresh(mail(spark, ("1", "cherry"), ("3", "pear")), 1)
    assert texts_of(index, spark, "apple").keys() == {"2"} and texts_of(index, spark, "cherry").keys() == {"1"}
    check_live(index, spark, folder, m1="cherry", m2="apple plum", m3="pear")
    index.compact(spark)
    check_live(index, spark, folder, m1="cherry", m2="apple plum", m3="pear")


def test_no_change_is_lost_inside_a_compaction(spark, folder):
    index, other = open_index(folder), open_index(folder)
    index.refresh(mail(spark, ("1", "apple"), ("2", "apple plum"), ("4", None)), 0)
    index.refresh(mail(spark, ("2", "plum plum")), 1)
    inside(index, "_write_postings", lambda: (other.refresh(mail(spark, ("1", "cherry"), ("4", "pear")), 2), other.delete(mail(spark, ("2", None)), 3)))
    index.compact(spark)
    check_live(index, spark, folder, m1="cherry", m4="pear")
    inside(index, "_write_postings", lambda: other.compact(spark))  # the slower compaction begins again
    index.compact(spark)
    check_live(index, spark, folder, m1="cherry", m4="pear")
    assert len(index.log.latest(spark).batches) == 1


def test_writers_of_the_same_key_at_the_same_time(spark, folder):
    index, other = open_index(folder), open_index(folder)
    index.refresh(mail(spark, ("1", "apple")), 0)
    inside(index, "_commit", lambda: other.refresh(mail(spark, ("1", "plum"), ("2", "plum")), 1, "other"))
    index.refresh(mail(spark, ("1", "cherry")), 1)
    check_live(index, spark, folder, m1="cherry", m2="plum")
    assert [b.n for b in index.log.latest(spark).batches] == [1, 2, 3]
    index.refresh(mail(spark, ("2", "pear")), 1)  # the batch again, without the key it had
    check_live(index, spark, folder, m2="pear")


def test_repeated_keys_in_a_batch_count_once(spark, folder):
    index = open_index(folder)
    rows = [("1", "apple", 1), ("1", "cherry", 3), ("1", "plum", 2), ("2", "pear", 1), ("2", "pear", 1), (None, "apple", 9)] + [("3", "plum", 5)] * 40
    batch = spark.createDataFrame([(i, "s", t, "x", n) for i, t, n in rows], MAIL + ", n int").repartition(3)
    index.refresh(batch, 0, newest="n")
    check_live(index, spark, folder, m1="cherry", m2="pear", m3="plum")
    index.refresh(batch.filter("id = '1'").drop("n"), 1)
    assert sum(bool(texts_of(index, spark, w)) for w in ("apple", "cherry")) + ("1" in texts_of(index, spark, "plum")) == 1


def test_a_file_is_created_once(spark, folder):
    assert create_text(spark, f"{folder}/log/1.json", "ü one") and not create_text(spark, f"{folder}/log/1.json", "two")
    assert read_text(spark, f"{folder}/log/1.json") == "ü one" and file_names(spark, f"{folder}/log") == ["1.json"]
    assert file_names(spark, f"{folder}/none") == []


def test_searches_read_few_blocks_and_miss_nothing(spark, folder):
    """One rare and one very frequent word: most blocks of the frequent one cannot hold an answer."""
    rng = random.Random(8)
    rows = []
    for i in range(3000):
        body = ["common"] * rng.choice([1, 1, 1, 2, 5]) + rng.choices(WORDS, k=rng.randint(0, 30)) + ["rare"] * (i % 270 == 7)
        rows.append((f"k{i:04d}", "s", " ".join(body), "x" if i % 4 else "y"))
    index = open_index(folder, block_rows=16)
    df = spark.createDataFrame(rows, MAIL).repartition(3)
    for part in range(2):
        index.refresh(df.filter(F.pmod(F.xxhash64("id"), F.lit(2)) == part), part)
    index.refresh(df.filter("id < 'k0100'").withColumn("body", F.lit("common quiet")), 2)
    for query in ("rare common", "common", "common quiet merger", "rare merger tip", "absent", "rare absent"):
        for k, where in ((3, None), (10, {"dept": "y"}), (400, None)):
            full = lexical_search.top_scores(index.lexical_scores(spark, query, where), "id", k)
            assert index.lexical_search(spark, query, k, where).collect() == full.collect()
    read = {r["term"]: r for r in index.blocks_read(spark, "rare common", 5).collect()}
    assert read["rare"].n_read == read["rare"].n_blocks and read["common"].n_blocks > 150
    assert 0 < read["common"].n_read < read["common"].n_blocks / 5
    assert index.blocks_read(spark, "common", 5).first().n_read < read["common"].n_blocks / 2


def test_a_question_writes_nothing(spark, corpus, folder, monkeypatch):
    from tierwatch.operators import hybrid_search
    index = open_index(folder)
    index.refresh(corpus, 0)
    monkeypatch.setattr(hybrid_search, "scratch_path", None)
    before = {name: len(file_names(spark, f"{index.root}/{name}")) for name in ("commits", "messages", "marks")}
    hits = index.answer(corpus, {"query": "merger tip", "columns": ["subject"], "limit": 4})
    assert hits.count() == 4 and "Exchange" not in index.vector_scores(spark, "merger")._jdf.queryExecution().executedPlan().toString()
    assert before == {name: len(file_names(spark, f"{index.root}/{name}")) for name in before}


def test_filters_of_requests(spark, corpus, folder):
    index = SearchIndex(folder, "messages", "id", "body", "subject", ["dept"], buckets=4)
    index.refresh(corpus, 0)
    word = corpus.filter("body IS NOT NULL").first()["body"].split()[0]
    ask = lambda wanted: index.answer(corpus, {"query": word, "columns": ["dept"], "filter": wanted, "limit": 50}).collect()
    first = corpus.filter("dept IS NOT NULL").first()["dept"]
    assert {r["dept"] for r in ask({"@eq": {"dept": first}})} == {first}
    assert ask({"@and": [{"@eq": {"dept": first}}, {"@not": {"@eq": {"dept": first}}}]}) == []
    assert {r["dept"] for r in ask({"@or": [{"@lte": {"dept": first}}, {"@gte": {"dept": first}}]})} >= {first}
    for wrong in ({"@in": {"dept": [first]}}, {"@eq": {"other": 1}}, {"@eq": {}}, {"@and": []}, {"@eq": {"dept": 1}, "@not": {}}):
        with pytest.raises(ValueError):
            ask(wrong)


def test_requests_against_the_index(spark, corpus, folder):
    index = SearchIndex(folder, "messages", "id", "body", "subject", ["dept"], buckets=4)
    index.refresh(corpus, 0)
    index.refresh(corpus, 0)  # the same batch again changes nothing
    index.describe(spark)
    hits = index.answer(corpus, '{"query": "it\'s quiet merger", "columns": ["id", "subject", "body", "dept"], '
                                '"filter": {"@eq": {"dept": "Research"}}, "limit": 4}').collect()
    assert len(hits) == 4 and {h["dept"] for h in hits} == {"Research"} and [h["rank"] for h in hits] == [1, 2, 3, 4]
    lexical = brute_bm25(texts(), "it s quiet merger", lambda r: r[3] == "Research")
    query = np.array(embed_literal("it's quiet merger"))
    vector = {}
    for i, subject, body, dept in texts():
        if dept == "Research" and body is not None:
            v = np.array(embed_literal(f"{subject} {body}"))
            vector[i] = round(float(v @ query / np.sqrt((v @ v) * (query @ query))), 10)
    assert [h["id"] for h in hits] == brute_fused(lexical, vector, 4, 60)
    assert [tuple(r)[:2] for r in list_indexes(spark, folder).collect()] == [("messages", "current")]
    nothing = index.answer(corpus, {"query": "merger", "columns": ["id"], "filter": {"@eq": {"dept": "None"}}, "limit": 3})
    assert nothing.count() == 0


def test_the_index_reads_only_the_buckets_of_the_query(spark, corpus, folder):
    index = SearchIndex(folder, "messages", "id", "body", "subject", [], buckets=16)
    index.refresh(corpus, 0)
    text = index.lexical_scores(spark, "merger")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in text and "EqualTo(term,merger)" in text


def test_restrictions_reach_the_scan(spark, folder):
    rows = [(i, datetime(2024, 1, 1, i), "Research" if i % 2 else "Trading", "A secret" if i < 6 else "b") for i in range(10)]
    spark.createDataFrame(rows, "id int, sent_at timestamp_ntz, dept string, body string").write.parquet(folder + "/m")
    kept = restrict(spark.read.parquet(folder + "/m"), since=datetime(2024, 1, 1, 2), until=datetime(2024, 1, 1, 5),
                    filter_eq={"dept": "Research"}, words=["secret"])
    assert [r["id"] for r in kept.collect()] == [3]
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(dept,Research)" in text and "GreaterThanOrEqual" in text.split("PushedFilters")[1]


def given_vectors(spark, sf):
    return spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding")


@pytest.mark.parametrize("window, find", [(24, lsh.more_like_graph), (4, lsh.more_like_graph), (24, lsh.more_like_lsh)])
def test_graph_with_large_buckets(spark, window, find):
    """A third of the rows are equal, the others in clusters that fill buckets of more rows than a window."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    rows = [centres[0] if i % 3 == 0 else centres[i % 20] + rng.normal(scale=0.15, size=16) for i in range(300)]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)] + [(900, None), (901, [1.0])],
                               "id long, embedding array<double>").repartition(5)
    found = find(df, 3, "id", tables=12, window=window).collect()
    exact = vs.vector_search_many(df, df, 3, "id", "id", exclude_self=True).collect()
    best = {}
    for r in exact:
        best.setdefault(r["query_id"], []).append(r["similarity"])
    # Equal rows tie, so what counts is the similarity reached.
    reached = [r["similarity"] >= min(best[r["query_id"]]) for r in found]
    assert len({r["query_id"] for r in found}) == 300 and max(r["rank"] for r in found) == 3
    assert sum(reached) >= 0.9 * sum(map(len, best.values())) and 900 not in best


def test_graph_finds_nearest_rows_and_scores_few_pairs(spark):
    """Random vectors, the hardest case: recall on ids divisible by 20, and pairs that do not grow with the square."""
    given = given_vectors(spark, "sf0.1")
    pairs = {}
    for n in (1000, 2000):
        scored = spark.sparkContext.accumulator(0)
        some = given.filter(f"vec_id < {n}")
        found = {r[:2]: r for r in lsh.more_like_graph(some, 3, "vec_id", scored=scored).collect()}
        asked = some.filter("vec_id % 20 = 0")
        exact = vs.vector_search_many(some, asked, 3, "vec_id", "vec_id", exclude_self=True).collect()
        assert len(exact) == 3 * n // 20 and sum(r[:2] in found for r in exact) >= 0.9 * len(exact)
        assert all(abs(found[r[:2]].similarity - r.similarity) < 1e-9 for r in exact if r[:2] in found)
        pairs[n] = scored.value
    assert pairs[2000] <= 0.3 * 2000 * 1999 / 2
    assert pairs[2000] <= 1.1 * pairs[1000] * 2 * math.log(2000) / math.log(1000)


def test_graph_of_copies_zeros_and_bad_rows(spark):
    given = given_vectors(spark, "sf0.001")
    extra = spark.createDataFrame([(10_000 + i, [0.0] * 64 if i < 3 else [1.0] * 64) for i in range(9)] +
                                  [(10_020, [float("nan")] * 64), (10_021, [float("nan")] * 64), (None, [1.0] * 64)],
                                  "vec_id long, embedding array<float>")
    whole = set(map(tuple, lsh.more_like_graph(given.union(extra), 3, "vec_id").collect()))
    assert {r[1:] for r in whole if r[0] == 10_004} == {(10_003, 1.0, 1), (10_005, 1.0, 2), (10_006, 1.0, 3)}
    assert not {10_020, 10_021, None} & {x for r in whole for x in r[:2]}
    assert lsh.more_like_graph(given.limit(0), 3, "vec_id", dim=64).count() == 0
    assert lsh.more_like_graph(given.limit(1), 3, "vec_id").count() == 0


def test_a_stored_vector_index_covers_every_row(spark, folder):
    """Clusters, copies, zeros and bad rows: few cells give nearly all answers, all cells the exact ones."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = [(i, [float(x) for x in (centres[0] if i % 3 == 0 else centres[i % 12] + rng.normal(scale=0.4, size=16))]) for i in range(600)]
    bad = [(900, None), (901, [1.0]), (902, [float("nan")] * 16), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows + [(903, [0.0] * 16)] + bad, "id long, embedding array<double>").repartition(4)
    index = VectorIndex(folder + "/index", "id", cells=12, parts=4)
    index.build(df, sample_rows=200)
    stored = spark.read.parquet(folder + "/index/codes")
    assert sorted(r.id for r in stored.collect()) == [*range(600), 903]
    asked = df.filter("id % 20 = 1 OR id > 899")
    exact = vs.vector_search_many(df, asked, 5, "id", "id", exclude_self=True).collect()
    every = index.search_many(asked, 5, "id", probes=12, rescored=None, exclude_self=True).collect()
    assert sorted(map(tuple, every)) == sorted(map(tuple, exact))
    some = {r[:2] for r in index.search_many(asked, 6, "id", probes=4, exclude_self=True).filter("rank <= 5").collect()}
    near = [r for r in exact if r.query_id != 903]
    assert sum(r[:2] in some for r in near) >= 0.9 * len(near)
    found = index.search(spark, rows[1][1], 3, probes=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.first()["id"] == 1 and "PartitionFilters: [cell" in plan
    with pytest.raises(ValueError):
        index.search_many(spark.range(3000).select("id", F.array(F.lit(1.0)).alias("embedding")), 1, "id")


def test_a_grid_shuffles_the_corpus_once_for_many_small_blocks_of_questions():
    groups = [vs.question_groups(-(-n // 200), 200, max(1, n // vs.CORPUS_BLOCK), 12) for n in (300, 10_000, 100_000, 600_000)]
    assert groups == [2, 24, 5, 30]


def test_a_vector_index_takes_any_number_of_questions_without_the_driver(spark, folder, monkeypatch):
    """Several blocks of questions and rows in each cell; pairs do not become rows, and nothing is broadcast."""
    from tierwatch.operators import vector_index

    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(3)
    index = VectorIndex(folder + "/index", "id", cells=3)
    index.build(df)
    monkeypatch.setattr(vector_index, "QUERY_BLOCK", 60)
    monkeypatch.setattr(vector_index, "CORPUS_BLOCK", 50)
    exact = sorted(map(tuple, vs.vector_search_many(df, df, 4, "id", "id", exclude_self=True).collect()))
    for rescored in (None, 120):
        found = index.search_many(df, 4, "id", probes=3, rescored=rescored, exclude_self=True, most_questions=None)
        assert sorted(map(tuple, found.collect())) == exact
        assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("window, dealt", [(5, 1), (5, 10**9), (40, 1), (40, 700)])
def test_sweeps_hand_on_the_best_pairs_only(spark, monkeypatch, window, dealt):
    """Lists are those of all pairs that meet in a bucket, whatever the rounds; few of the pairs are shuffled."""
    setting, handed, lists = "spark.sql.shuffle.partitions", [], lsh._lists
    monkeypatch.setattr(lsh, "FIRST_DEALT", dealt, raising=False)
    monkeypatch.setattr(lsh, "SWEPT_ROWS", 250, raising=False)
    monkeypatch.setattr(lsh, "PAIRS_HELD", 3000, raising=False)

    def counted(edges, size):
        kept = edges.persist()
        handed.append(kept.count())
        return lists(kept, size)

    monkeypatch.setattr(lsh, "_lists", counted)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(400, 8)) + np.repeat(rng.normal(size=(8, 8)), 50, axis=0)
    rows = [(f"r{i:03d}", [float(x) for x in v]) for i, v in enumerate(vectors)]
    classes = spark.createDataFrame(rows, "_lead string, _vector array<double>").repartition(3)
    scored, before = spark.sparkContext.accumulator(0), spark.conf.get(setting)
    try:
        spark.conf.set(setting, "1")  # pairs on both sides of a border of tasks do not meet
        graph = lsh.neighbour_graph(classes, 8, 4, tables=12, bucket_rows=40, window=window, rounds=0, scored=scored)
        found = {}
        for r in graph.collect():
            found.setdefault(r["_query"], {})[r["_lead"]] = r["score"]
    finally:
        spark.conf.set(setting, before)
    unit = {i: np.asarray(v) / np.linalg.norm(v) for i, v in rows}
    near, pairs = {}, 0
    at = classes.select("_lead", lsh._codes(F.col("_vector"), 8, 12, 10, 7).alias("at")).collect()
    for t in range(12):
        line = sorted((r["at"]["codes"][t], r["at"]["place"], r["_lead"]) for r in at)
        for i, a in enumerate(line):
            for b in line[i + 1:i + 1 + window]:
                if a[0] == b[0]:
                    pairs += 1
                    score = round(float(unit[a[2]] @ unit[b[2]]), 10)
                    near.setdefault(a[2], {})[b[2]] = near.setdefault(b[2], {})[a[2]] = score
    assert scored.value == pairs and found.keys() == near.keys()
    for i, others in near.items():
        assert sorted(found[i].values()) == pytest.approx(sorted(others.values())[-4:], abs=1e-9)
        assert all(found[i][j] == pytest.approx(others[j], abs=1e-9) for j in found[i])
    # Each round hands on the lists of the one before as well.
    assert sum(handed) <= (0.5 if window > 5 else 1.4) * pairs, (handed, pairs)


def test_rounds_of_tables_deal_out_few_rows():
    assert [len(lsh.table_rounds(n, 120)) for n in (0, 2000, 10_256)] == [1, 1, 2]
    for n in (51_282, 615_360, 6_000_000, 10**9):
        rounds = lsh.table_rounds(n, 120)
        assert [t for r in rounds for t in r] == list(range(120)) and all(len(r) == 1 or len(r) * n <= lsh.ROWS_DEALT for r in rounds)


def test_buckets_grow_with_the_rows():
    assert [lsh.bucket_size(n) for n in (0, 10, 2000, 10_000, 50_000)] == [2, 2, 2, 5, 14]


def test_a_refresh_cuts_each_text_once_and_stores_vectors_as_bytes(spark, folder, monkeypatch):
    """Terms and vectors are those of the two functions apart, also of nulls and of folders with arrays from earlier versions."""
    class OneNumber:
        """An embedder that says nothing of words: it takes whole texts."""

        name, dim = "one-number", 1

        def encode(self, texts):
            return np.array([[float(len(t))] for t in texts.to_pylist()])

    rows = [("1", "Sub ject", "Eins zwei, zwei", "x"), ("2", None, "beta", "x"), ("3", "s", None, "y"), ("4", "É—é", "İ ß " * 400, "y"), ("5", "", "", "y")]
    df = spark.createDataFrame(rows + [(f"n{i}", f"a{i}", f"b{i} b", "x") for i in range(1500)], MAIL).repartition(2)
    text = F.concat("subject", F.lit(" "), "body")
    for embedder, chars in ((None, None), (None, 5), (OneNumber(), None)):
        cut = lambda x: F.substring(x, 1, chars) if chars else x
        made = embedding.terms_and_vector(F.col("subject"), F.col("body"), embedder, chars)
        got = df.select("id", made["terms"].alias("terms"), embedding.unpacked(made["embedding"]).alias("v")).collect()
        apart = df.select("id", embedding.term_counts(F.col("body")).alias("terms"),
                          embedding.embed(F.concat("subject", F.lit(" "), cut(F.col("body"))), embedder).alias("v")).collect()
        assert sorted(got) == sorted(apart) and len(got) == 1505
    plan = df.select(embedding.terms_and_vector(F.col("subject"), F.col("body")).alias("c")).select("c.*")
    assert plan._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1

    index = open_index(folder)
    index.refresh(df.filter("id > '2'"), 0)
    stored = spark.read.parquet(f"{index.root}/messages")
    assert stored.schema["embedding"].dataType.simpleString() == "binary"
    data, = index.log.latest(spark).numbers("data")
    assert data.endswith("-packed")
    # A batch as earlier versions stored it: arrays, in a folder without the ending.
    real = embedding.terms_and_vector
    monkeypatch.setattr(search_index, "_PACKED", "")
    monkeypatch.setattr(search_index, "terms_and_vector", lambda *a: F.struct(
        real(*a)["terms"].alias("terms"), embedding.unpacked(real(*a)["embedding"]).alias("embedding")))
    index.refresh(df.filter("id <= '2'"), 1)
    monkeypatch.undo()
    wanted = {r["id"]: r["v"] for r in df.select("id", embedding.embed(text).alias("v")).collect()}
    for _ in range(2):
        assert {r["id"]: r["embedding"] for r in index.vectors(spark).collect()} == wanted
        scores = {r["id"]: r["score"] for r in index.vector_scores(spark, "zwei b7").collect()}
        given = vs.vector_scores(df.select("id", embedding.embed(text).alias("embedding")), embed_literal("zwei b7"), "id").collect()
        assert scores == {r["id"]: r["score"] for r in given} and len(scores) == 1503
        index.compact(spark)


def test_blocks_do_not_depend_on_small_arrow_batches(spark):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    terms = F.array(*(F.struct(t.alias("term"), F.lit(2).alias("tf")) for t in (F.lit("common"), F.concat(F.lit("own"), F.col("id").cast("string")))))
    messages = spark.range(0, 640, 1, 1).select(F.col("id").alias("email_id"), terms.alias("terms"), F.lit(4).alias("length"),
                                                F.lit(None).cast("long").alias("since"), F.lit("en").alias("lang"))
    try:
        spark.conf.set(setting, "10")
        found = postings.pack(messages, "email_id", ["lang"], 4).collect()
    finally:
        spark.conf.set(setting, before)
    common = [r for r in found if r.term == "common"]
    assert [r.n for r in common] == [postings.BLOCK_ROWS] * 5 and sorted(k for r in common for k in r.email_id) == list(range(640))
    assert len(found) == 645 and all(r.tf == [2] * r.n and r.lang == ["en"] * r.n for r in found)


def test_words_are_hashed_together_as_one_by_one():
    words = ["", "a", "x" * 55, "x" * 56, "\u00e9" * 27, "\u00e9" * 28, "z" * 64, "q" * 300, *(f"w{i}\u6c34" for i in range(40_000))]
    wanted = [int.from_bytes(hashlib.md5(w.encode()).digest()[:4], "big") for w in words]
    assert first_of_md5(pa.array(words)).tolist() == wanted
    assert first_of_md5(pa.array(words).slice(3, 100)).tolist() == wanted[3:103] and len(first_of_md5(pa.array([], pa.string()))) == 0
