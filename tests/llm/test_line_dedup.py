"""Shared lines against plain Python."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

from tierwatch.llm import line_dedup as ld

SPACE = "[\x20\x09-\x0d]"


def plain(rows, min_chars, min_docs):
    """Sorted (id, lines, dropped, text) of (id, text) rows."""
    def key(line):
        stripped = re.sub(f"^{SPACE}+|{SPACE}+$", "", line)
        return re.sub("[A-Z]", lambda m: m[0].lower(), stripped)

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars and doc is not None:
                holders.setdefault(key(line), set()).add(doc)
    kept = {k: max(d) for k, d in holders.items() if len(d) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key(x) not in kept or kept[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def run(spark, rows, min_chars, min_docs, partitions=3):
    docs = spark.createDataFrame([(t, "x", d, 1) for d, t in rows], "body string, keep string, id long, kind int").repartition(partitions)
    marks = ld.keep_bitmaps(docs, min_chars, min_docs, "id", "body")
    return sorted(map(tuple, ld.drop_lines(docs, marks, "id", "body").collect()), key=repr)


def random_rows(seed, n, ids, words):
    choose = random.Random(seed)
    shared = ["".join(choose.choice("aBé 😀\t") for _ in range(choose.randint(0, 9))) for _ in range(words)]
    rows = [(choose.choice(ids), "\n".join(choose.choice(shared) + choose.choice(["", " ", "\r", "\x0b\t", " "])
                                           for _ in range(choose.randint(0, 6)))) for _ in range(n)]
    return rows + rows[:n // 3] + [(None, None), (1, None), (2, "")]


@pytest.mark.parametrize("seed", range(3))
def test_random_lines(spark, seed):
    rows = random_rows(seed, 60, [None, *range(25)], 12)
    assert run(spark, rows, 3, 4) == plain(rows, 3, 4)


def test_one_line_over_many_ranges(spark):
    """A line of most rows lies over all ranges, its neighbours at their borders."""
    hot = "The One Line of them all, " * 3
    rows = [(i, f"{hot}\n own line of number {i}, which is long enough for a key of its own \n{hot.upper()}") for i in range(400)]
    rows += [(i, "x" * 39 + "é\n" + "y" * 39) for i in range(5)] + [(None, hot), (None, hot)] + [(7, hot)] * 50
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert run(spark, rows, 40, 5, 7) == plain(rows, 40, 5)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_stream_decides_alike_for_any_batches(size):
    """Sorted entries in batches of any size, some of their ids missing."""
    choose = random.Random(size)
    entries = sorted({(k, 0, d, t) for k in range(40) for d in choose.sample(range(9), choose.randint(1, 8)) for t in range(choose.randint(1, 3))},
                     key=lambda e: (e[0], -e[2], e[3]))
    nulls = [(k, 0, None, 0) for k in range(0, 40, 3)]
    entries = sorted(entries + nulls, key=lambda e: (e[0], e[2] is None, -(e[2] or 0), e[3]))
    stream, out = ld._Stream(5), []
    for i in range(0, len(entries), size):
        part = entries[i:i + size]
        columns = [pa.array([e[j] for e in part], pa.int64()) for j in range(4)]
        columns += [pa.array([1] * len(part), pa.int32()), pa.array([b""] * len(part), pa.binary())]
        out += [r for b in stream.take(pa.RecordBatch.from_arrays(columns, names=ld._NAMES)) for r in b.to_pylist()]
    out += [r for b in stream.close(last=True) for r in b.to_pylist()]
    ids = {k: {e[2] for e in entries if e[0] == k and e[2] is not None} for k in range(40)}
    borders = {0, 39}
    wanted = {(k, d, t) for k, _, d, t in entries if len(ids[k]) >= 5 and d != max(ids[k]) and k not in borders}
    found = [(r["hi"], r["doc_id"], r["row_key"]) for r in out if r["kind"] == ld._DROP]
    assert len(found) == len(set(found)) and {f for f in found if f[0] not in borders} == wanted
    assert {(r["hi"], r["n_docs"], r["doc_id"]) for r in out if r["kind"] == ld._COUNT} == {(k, len(ids[k]), max(ids[k])) for k in borders}
    assert {(r["doc_id"], r["row_key"]) for r in out if r["kind"] == ld._WAIT and r["hi"] == 0} == {(e[2], e[3]) for e in entries if e[0] == 0}


def test_long_text_and_empty_table(spark):
    line = "a line that is found in five documents, no less"
    rows = [(i, "\n".join([line] * (20_000 if i == 2 else 1))) for i in range(5)] + [(9, "z" * 2_000_000)]
    assert run(spark, rows, 40, 5) == plain(rows, 40, 5)
    assert run(spark, [], 40, 5) == []


def test_query_keeps_every_row(spark):
    found = ld.op11_line_dedup(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == 200 and {len(r.kept_sha256) for r in found} == {64}
    assert all(r.kept_sha256 != hashlib.sha256(b"").hexdigest() for r in found if r.n_lines > r.n_dropped and r.n_dropped)
