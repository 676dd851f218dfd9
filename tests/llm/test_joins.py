"""The set join, components and the pipeline against plain Python."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_rows import slow_contamination, slow_measures
from tierwatch.llm import quality_classifier, quality_rules, set_join
from tierwatch.llm.components import components

SF = "/root/testdata/sf0.001"


def roots(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_components_against_union_find(spark, seed):
    draw = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in draw.integers(0, 60, (35, 2))] + [(i, i + 1) for i in range(60, 90)] + [(95, i) for i in range(96, 120)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = roots(120, links)
    touched = {x for pair in links if pair[0] != pair[1] for x in pair}
    assert found == {x: wanted[x] for x in touched}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_sets(texts, size):
    out = []
    for text in texts:
        ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append({tuple(ws[i:i + size]) for i in range(max(len(ws) - size + 1, 1))} if ws else set())
    return out


def slow_components(texts, measure):
    sets = slow_sets(texts, measure.size)
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and
             100 * len(sets[i] & sets[j]) >= measure.percent * len(sets[i] | sets[j])]
    return sets, roots(len(sets), links)


def families(seed, n_bases=6, copies=12):
    """Texts of many sizes, each with copies that differ in a few words, and copies of copies."""
    draw, texts = np.random.default_rng(seed), []
    passage = " ".join(f"shared{i}" for i in range(60))
    for base in range(n_bases):
        ws = [f"b{base}w{i}" for i in range(int(draw.integers(1, 220)))]
        ws += passage.split() if base % 2 else []
        for _ in range(copies):
            texts.append(" ".join(ws))
            if draw.random() < 0.3:
                ws = list(ws)
            copy = list(ws)
            for _ in range(int(draw.integers(0, max(1, len(ws) // 25) + 1))):
                copy[int(draw.integers(0, len(copy)))] = f"new{draw.integers(0, 9)}"
            ws = copy if draw.random() < 0.4 else ws
            texts.append(" ".join(copy[:len(copy) - int(draw.integers(0, 3))]) if len(copy) > 9 else " ".join(copy))
    return texts + [None, "", " \n", "One", "one", "two Words", "TWO words", "a b c", "a b c d"]


@pytest.mark.parametrize("seed, measure, group_shingles", [
    (1, set_join.Measure(3, 90), set_join.GROUP_SHINGLES), (2, set_join.Measure(3, 90), 900),
    (3, set_join.NEAR_COPIES, set_join.GROUP_SHINGLES), (4, set_join.NEAR_COPIES, 700)])
def test_set_join_against_all_pairs(spark, seed, measure, group_shingles):
    texts = families(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, class string")
    got = {r.doc_id: r for r in set_join.join_sets(docs, measure, group_shingles=group_shingles).collect()}
    sets, wanted = slow_components(texts, measure)
    assert [got[i].n_shingles for i in range(len(texts))] == list(map(len, sets))
    assert [got[i].component_id for i in range(len(texts))] == wanted
    assert len({(c, r.text_hash) for r in got.values() if r.kept and r.n_shingles for c in [r.component_id]}) == \
        len({w for w, s in zip(wanted, sets) if s})


@pytest.mark.parametrize("seed, measure, group_shingles", [
    (5, set_join.NEAR_COPIES, set_join.GROUP_SHINGLES), (6, set_join.NEAR_COPIES, 700)])
def test_every_link_is_counted_once(spark, seed, measure, group_shingles):
    texts = families(seed, 4, 10)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_links for r in set_join.join_sets(docs, measure, group_shingles=group_shingles).collect()}
    sets = slow_sets(texts, measure.size)
    different = {frozenset(s) for s in sets if s}
    wanted = [sum(100 * len(s & o) >= measure.percent * len(s | o) for o in different if o != s) if s else 0 for s in sets]
    assert [got[i] for i in range(len(texts))] == wanted and max(wanted) > 2


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (1, 70)])
def test_linked_sets_share_a_list(size, percent):
    """Sets at the limit of the similarity, of many sizes, always have a key in common."""
    measure, draw = set_join.Measure(size, percent), np.random.default_rng(size)
    for n in [*range(1, 60), 100, 333, 2000]:
        for _ in range(6 if n > 60 else 30):
            whole = draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
            cut = int(draw.integers(0, n * (100 - percent) // 100 + 1))
            spare = [m for m in range(3 * n) if 100 * (n - cut) >= percent * (n + m)]
            if not spare:
                continue
            added = draw.integers(0, 1 << 63, max(spare), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            pair = [np.unique(whole), np.unique(np.concatenate([whole[cut:], added]))]
            common = len(np.intersect1d(*pair))
            if not measure.linked(np.array([common]), len(pair[0]), np.array([len(pair[1])]))[0]:
                continue
            bounds, keys = set_join.signatures(np.cumsum([0, *map(len, pair)]), np.concatenate(pair), measure)
            assert set(keys[:bounds[1]].tolist()) & set(keys[bounds[1]:].tolist())


def test_set_join_rows_without_ids_and_repeats(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (7, text), (7, text), (5, text + " more"), (None, "other words here"), (7, "x y z"), (7, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in set_join.join_sets(docs).collect())
    assert got == {(None, 38, 5): 1, (7, 38, 5): 2, (5, 39, 5): 1, (None, 1, None): 1, (7, 1, 7): 1, (7, 0, 7): 1, (None, 0, None): 1}
    kept = set_join.keep_one(docs, set_join.Measure())
    assert kept.columns == docs.columns
    assert collections.Counter(map(tuple, kept.collect())) == {(5, text + " more"): 1, (None, "other words here"): 1,
                                                               (7, "x y z"): 1, (7, None): 1, (None, None): 1}
    assert set_join.keep_one(docs.limit(0), set_join.Measure()).count() == 0


def test_pipeline_against_plain_python(spark):
    """Each stage on its own input; the score of the classifier is taken from the operator."""
    sf, docs = SF, spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    machine = quality_classifier.learnt_from(spark, sf, docs)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "quality_classifier", "near_copies", "benchmark_decontamination", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        scores = {r.doc_id: r.s for r in docs.select("doc_id", quality_classifier.score(machine, F.col("text")).alias("s")).collect()}
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns
        after = spark.createDataFrame(after.collect(), docs.schema)
        got = {r.doc_id: r for r in after.collect()}
        texts = [r.text for r in before.values()]
        if name == "quality_rules":
            judged = {d: dict(zip(quality_rules.MEASURES, slow_measures(r.text))) for d, r in before.items()}
            fails = lambda m: any(eval(rule.fails, {}, m) for rule in quality_rules.RULES)
            assert set(got) == {d for d, m in judged.items() if not fails(m)}
        elif name == "quality_classifier":
            assert set(got) == {d for d in before if scores[d] >= 0.5}
        elif name == "near_copies":
            ids = list(before)
            order = sorted(range(len(ids)), key=lambda i: ids[i])
            _, wanted = slow_components([texts[i] for i in order], set_join.NEAR_COPIES)
            assert set(got) == {ids[order[w]] for w in wanted}
        else:
            hits = slow_contamination(texts, benchmark)
            for (doc, row), (_, n_hit, _) in zip(before.items(), hits):
                assert n_hit or got[doc] == row
            assert not any(n for _, n, _ in slow_contamination([r.text for r in got.values()], benchmark))
        docs = after
    assert set(corpus_pipeline.packing(spark, docs, sf).select("doc_id").distinct().toPandas().doc_id) == set(got)


def test_pipeline_on_an_empty_table_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0)], docs.schema)
    for table in (docs.limit(0), odd):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, table, SF).count() >= 0
