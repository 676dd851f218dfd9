"""Operators that judge row by row: quality rules, classifier, URL filter, decontamination."""

import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierwatch.llm import decontaminate, quality_classifier, quality_rules, url_filter

SF = "/root/testdata/sf0.001"


def slow_measures(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = collections.defaultdict(list)
    for i in range(len(found) - 7):
        grams[tuple(found[i:i + 8])].append(i)
    covered = {i + k for places in grams.values() if len(places) > 1 for i in places for k in range(8)}
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)),
            len(covered), len(re.findall("[A-Z]", text)))


def edge_rows(spark):
    texts = [None, "", "  \n\t ", "one", "a b c d e f g h " * 3, "x\nx\n x\nx", "é “q” 😀 |#", "w " * 3000, "last", "last"]
    rows = [(i if i else None, t, 5, "s") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, bits int, m string")


def test_measures_and_verdicts(spark):
    docs = edge_rows(spark).unionByName(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), allowMissingColumns=True)
    judged = quality_rules.apply_policy(quality_rules.ledger(docs)).collect()
    wanted = collections.Counter((r.doc_id, *slow_measures(r.text)) for r in docs.collect())
    assert collections.Counter((r.doc_id, *(r[m] for m in quality_rules.MEASURES)) for r in judged) == wanted
    for r in judged:
        few, repeated = r.n_words < 20, 100 * r.n_repeat_words > 30 * r.n_words
        assert bool(r.bits & 1) == few and bool(r.bits & 2) == repeated and r.kept == (r.bits == 0)


def test_kept_rows_keep_their_columns(spark):
    docs = edge_rows(spark).withColumn("text", F.concat_ws(" ", "text", F.lit(" ".join(f"word{i}" for i in range(30)))))
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert quality_rules.keep_good(docs.limit(0)).count() == 0


def test_ablations_against_the_ledger(spark):
    ledger = quality_rules.ledger(spark.read.parquet(f"{SF}/documents.parquet")).cache()
    bits = [r.bits for r in ledger.select("bits").collect()]
    for row in quality_rules.ablations(ledger).collect():
        bit = quality_rules.BIT[row.rule]
        assert row.failing == sum(bool(b & bit) for b in bits)
        assert row.failing_alone == bits.count(bit) and row.kept_without == sum(b & ~bit == 0 for b in bits)


def test_classifier_on_held_out_labels(spark):
    scored = quality_classifier.op5_quality_classifier(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = scored.filter("held_out").join(labels, "doc_id").select("predicted", "quality").collect()
    assert len(rows) > 80 and np.mean([r.predicted == r.quality for r in rows]) > 0.95
    again = quality_classifier.op5_quality_classifier(spark, "/root/testdata/sf0.01")
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in scored.collect()}


def test_pairs_in_linear_time_are_all_pairs():
    draw = np.random.default_rng(3)
    x = quality_classifier.featurize(pa.array(["Some text, here. some", "", None, "A B a"]), [("n_chars", ["3", None, "x", "-1"])])
    machine = quality_classifier.untrained(["n_chars"])
    machine.weights, machine.factors = (draw.normal(size=a.shape).astype(np.float64) for a in (machine.weights, machine.factors))
    for row, got in enumerate(machine.logits(x)):
        at = slice(x.bounds[row], x.bounds[row + 1])
        f, v = x.features[at], x.values[at].astype(np.float64)
        pairs = sum(machine.factors[f[i]] @ machine.factors[f[j]] * v[i] * v[j] for i in range(len(f)) for j in range(i))
        assert got == pytest.approx(machine.weights[f] @ v + pairs, rel=1e-4)


def test_classifier_edge_rows(spark):
    docs = edge_rows(spark).withColumn("n_chars", F.when(F.col("doc_id") > 3, F.length("text")))
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (4, 7), (None, 1), (9, 0)], "doc_id long, quality int")
    for known, fixed in ((labels, False), (labels.limit(0), True)):
        machine = quality_classifier.train(docs, known, max_rows=50)
        scores = [r[0] for r in docs.select(quality_classifier.score(machine, F.col("text"))).collect()]
        assert len(scores) == 10 and all(0 <= s <= 1 for s in scores) and (not fixed or set(scores) == {0.5})
    machine = quality_classifier.train(docs.limit(0), labels)
    assert docs.limit(0).select(quality_classifier.score(machine, F.col("text"))).count() == 0


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://example.net/de/", "example.net", "/de/", "net/", "block"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
    ("ftp://example.com/de/a://b", "example.com", "/de/a://b", "example.com/de/", "block"),
    ("http://x.org?/fr/", "x.org", "", None, "allow"),
    ("http://net", "net", "", None, "allow"),
    (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("no scheme/xxx", "", "", None, "block"),
    ("http://a.com/casino", "a.com", "/casino", None, "allow"),
    ("http://a.com/casino-FREE", "a.com", "/casino-FREE", None, "block"),
    ("http://a.com/casino/casino", "a.com", "/casino/casino", None, "allow"),
    ("http://a.com/freedom-casinos", "a.com", "/freedom-casinos", None, "allow"),
    ("http://xxx.com", "xxx.com", "", None, "block"), ("http://a.com/xxxx", "a.com", "/xxxx", None, "allow"),
])
def test_url_verdicts(spark, url, host, path, rule, verdict):
    book, vocabulary = url_filter.RuleBook(url_filter.RULES), url_filter.Vocabulary(url_filter.VOCABULARY)
    assert url_filter.parts(url) == (host, path)
    found = book.longest(host, path)
    assert (found and found.name) == rule
    weight = sum(vocabulary.hits(url).values())
    assert (found.verdict if found else "block" if weight >= url_filter.STRICT else "allow") == verdict


def test_url_rows_and_ties(spark):
    pages = spark.createDataFrame([(1, "http://b.a/c/d", "x"), (None, None, "x"), (1, "http://b.a/c/d", "x")],
                                  "page_id long, url string, host string")
    tied = [url_filter.HostRule("block", "a", "/c/d"), url_filter.HostRule("allow", "b.a", "/c")]
    got = url_filter.judge(pages, tied, {}).select("page_id", "rule", "verdict").collect()
    assert sorted(map(str, got)) == sorted(map(str, [*2 * [(1, "b.a/c", "allow")], (None, None, "allow")])) or \
        collections.Counter(tuple(r) for r in got) == {(1, "b.a/c", "allow"): 2, (None, None, "allow"): 1}
    assert url_filter.judge(pages.limit(0)).count() == 0


def slow_contamination(texts, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = collections.defaultdict(set)
    for name, text in items:
        ws = split(text)
        for i in range(max(len(ws) - window + 1, 1) if ws else 0):
            grams[tuple(ws[i:i + window])].add(str(name))
    out = []
    for text in texts:
        ws, hit, named = split(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(ws) - n + 1):
                if tuple(ws[i:i + n]) in grams:
                    hit.update(range(i, i + n))
                    named |= grams[tuple(ws[i:i + n])]
        out.append((len(ws), len(hit), sorted(named)))
    return out


@pytest.mark.parametrize("seed, block_bytes", [(1, 1 << 20), (2, 200), (3, 40)])
def test_contamination_against_all_windows(spark, monkeypatch, seed, block_bytes):
    draw = np.random.default_rng(seed)
    text = lambda n, k: " ".join(draw.choice([f"w{i}" for i in range(k)], n))
    items = [(i, text(int(draw.integers(0, 25)), 3)) for i in range(12)] + [(40, "Solo"), (5, "b, c"), (41, None), (42, "--")]
    texts = [text(int(draw.integers(0, 120)), 4) for _ in range(40)] + [None, "", "solo. SOLO", "x b-c x"]
    texts += [f"before {t} and AFTER, {t}" for _, t in items[:6]]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_hit int")
    paths = decontaminate.item_blocks(spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    assert (len(paths) > 1) == (block_bytes < 1000)
    found = docs.select("doc_id", decontaminate.search(F.col("text"), paths).alias("f")).select("doc_id", "f.*")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found.collect()}
    assert [got[i] for i in range(len(texts))] == slow_contamination(texts, items)


def test_passages_are_cut_out_until_none_is_left(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    first, second = passage.split(" p5 ")
    texts = ["clean text stays", f"x, {passage}! y", f"a {first} p5 {passage} {second} b", passage, None, ""]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = {r.doc_id: (r.text, r.n_chars) for r in decontaminate.cut_benchmark(docs, items).collect()}
    assert got[0] == (texts[0], 7) and got[1] == ("x, ! y", 6) and got[4] == (None, 7) and got[5] == ("", 7) and 3 not in got
    assert all(n == 0 for _, n, _ in slow_contamination([t for t, _ in got.values()], [(1, passage)]))
    assert decontaminate.cut_benchmark(docs, items.limit(0)).count() == len(texts)


def test_fm_index_against_plain_search():
    draw = np.random.default_rng(5)
    text = np.append(draw.integers(0, 4, 400), 0)
    index = decontaminate.FMIndex(text, 3)
    rows = [r for n in (1, 2, 5) for r in np.unique([text[i:i + n] for i in range(400 - n) if 0 not in text[i:i + n]], axis=0)]
    patterns = np.array([np.concatenate([np.zeros(5 - len(r), np.int64), r]) for r in rows])
    low, high = index.search(patterns, (patterns > 0).sum(axis=1))
    for row, a, b in zip(rows, low, high):
        wanted = [i for i in range(len(text) - len(row) + 1) if np.array_equal(text[i:i + len(row)], row)]
        assert sorted(index.locate(np.arange(a, b))) == wanted
