"""Sharding and classifier against plain Python and held-out labels."""

import hashlib
import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from tierwatch.llm import quality_classifier as qc, sharding

SF = "/root/testdata/sf0.001"


def test_sharding_against_sorted_ranks(spark):
    """Rank in each source by the seeded hash, sort all by fractional rank, cut into equal stretches."""
    given = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    edge = [(None, None, None), (1_000, "", None), (1_001, None, "src0"), (1_002, "é", "src0"), (1_002, "é", "src0")]
    rows = given + edge
    docs = spark.createDataFrame([(i, t, s, 7) for i, t, s in rows], "doc_id long, text string, source string, shard int").repartition(5)

    described = []
    for doc, text, source in rows:
        raw = (text or "").encode()
        crc = zlib.crc32(raw)
        name = ":".join([sharding.SEED, *([str(doc)] if doc is not None else []), str(crc)])
        shuffled = int(hashlib.md5(name.encode()).hexdigest()[:14], 16)
        described.append(("null" if source is None else f"={source}", shuffled, -1 if doc is None else doc, crc, len(raw) + 8))
    by_source = {}
    for d in sorted(described):
        by_source.setdefault(d[0], []).append(d)
    order = sorted((2 * i - 1, len(ds), *d) for ds in by_source.values() for i, d in enumerate(ds, 1))
    order = sorted(order, key=lambda o: ((o[0]) / (2 * o[1]), *o[2:]))
    n = len(order)
    wanted = []
    for i, (_, _, _, _, doc, crc, size) in enumerate(order):
        shard = i * 24 // n
        wanted.append((doc, size, crc, shard, i - -(-shard * n // 24)))
    for per_interval in (sharding.ROWS_PER_INTERVAL, 11):
        placed = sharding.interleave(docs, rows_per_interval=per_interval).collect()
        got = [(-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in placed]
        assert sorted(got) == sorted(wanted)


def test_scores_against_all_pairs(spark):
    """The query's scores are the sigmoid of bias, weights and every pair's product, one by one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id % 9 = 0")
    machine = qc.learnt_from(spark, SF, spark.read.parquet(f"{SF}/documents.parquet"))
    rows = docs.select("doc_id", qc.sparse_features(F.col("text"), machine.metadata).alias("x"),
                       qc.score(machine, F.col("text")).alias("score")).collect()
    assert len(rows) > 15
    for r in rows:
        at, values = list(r.x.features), np.array(r.x["values"], float)
        factors = machine.factors[at].astype(float)
        pairs = sum(float(factors[i] @ factors[j]) * values[i] * values[j] for i in range(len(at)) for j in range(i))
        logit = machine.bias + float(machine.weights[at].astype(float) @ values) + pairs
        assert math.isclose(r.score, 1 / (1 + math.exp(-logit)), abs_tol=1e-4)


def test_held_out_labels(spark):
    """Rows whose labels were not learnt from."""
    sf = "/root/testdata/sf0.01"
    found = qc.op5_quality_classifier(spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, poor = [r.score for r in found if r.quality == 1], [r.score for r in found if r.quality == 0]
    assert len(good) > 30 and len(poor) > 10
    assert sum(r.predicted == r.quality for r in found) >= 0.9 * len(found)
    assert sum((a > b) + (a == b) / 2 for a in good for b in poor) >= 0.95 * len(good) * len(poor)
