import collections
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from tierwatch.sources import catalog, contract, files, schemas, sinks

CSV = '''email_id,sender,recipient,cc,subject,body,sent_at,sender_dept,recipient_dept,compliance_label
1,a,b,,"Hi, ""you""","line1
line2",2024-01-02T03:04:05,Research,Trading,CLEAN
2,a,b,"",s,b,not-a-time,Research,Trading,CLEAN
3,a,b,c
,a,b,,s,b,2024-01-02T03:04:05,Research,Trading,CLEAN
5,a,b,,s,b,2024-01-02T03:04:05,Research,Trading,CLEAN,extra
6,a,b,,,"",2024-01-02T03:04:05,Research,Trading,CLEAN
'''


def test_read_messages_keeps_what_it_rejects(spark, tmp_path):
    (tmp_path / "m.csv").write_text(CSV)
    accepted, rejected = files.read_messages(spark, str(tmp_path / "m.csv"))
    rows = {r["email_id"]: r for r in accepted.collect()}
    assert set(rows) == {"1", "6"}
    assert rows["1"]["subject"] == 'Hi, "you"' and rows["1"]["body"] == "line1\nline2" and rows["1"]["cc"] is None
    assert rows["1"]["sent_at"] == datetime(2024, 1, 2, 3, 4, 5) and rows["1"]["loaded_at"] is not None
    assert rows["6"]["subject"] is None and rows["6"]["body"] is None
    reasons = {r["email_id"]: r["reject_reason"] for r in rejected.collect()}
    assert reasons == {"2": "sent_at is not timestamp_ntz", "3": "wrong number of columns; sent_at is missing",
                       None: "email_id is missing", "5": "wrong number of columns"}
    # Counting reads fewer columns; the split must not depend on that.
    assert (accepted.count(), rejected.count()) == (2, 4)


def test_read_pairs(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text(
        '{"prompt": "a", "completion": "VIOLATION"}\nnot json\n{"prompt": 3, "completion": {"x": 1}}\n{"prompt": "only"}\n')
    accepted, rejected = files.read_pairs(spark, str(tmp_path / "p.jsonl"))
    assert [tuple(r) for r in accepted.collect()] == [("a", "VIOLATION"), ("3", '{"x":1}')]
    assert [tuple(r) for r in rejected.collect()] == [
        ("not json", "not JSON"), ('{"prompt": "only"}', "completion is missing")]


def test_export_then_import_gives_the_same_rows(spark, folder):
    rows = [(str(i), "a", "b", None, 'quote " and, comma', f"two\nlines {i}\\ ", datetime(2024, 1, 1 + i % 3), "x", None, "CLEAN")
            for i in range(20)]
    df = spark.createDataFrame(rows, schemas.MESSAGES)
    sinks.export_csv(df, folder + "/out", ["sent_at", "email_id"])
    accepted, rejected = files.read_messages(spark, folder + "/out")
    assert rejected.count() == 0
    assert accepted.drop("loaded_at").exceptAll(df).count() == 0 and accepted.count() == 20


def test_export_is_ordered_over_files(spark, tmp_path):
    df = spark.range(1000).select((1000 - F.col("id")).alias("k"), F.lit("t").alias("s"))
    sinks.export_csv(df, str(tmp_path / "out"), ["k"])
    lines = []
    for part in sorted((tmp_path / "out").glob("part-*.csv")):
        lines += [int(x.split(",")[0]) for x in part.read_text().splitlines()[1:]]
    assert lines == sorted(lines) and len(lines) == 1000


def test_contract_lengths_and_missing_columns(spark):
    schema = schemas.T.StructType([schemas.T.StructField("a", schemas.T.StringType(), False),
                                   schemas.T.StructField("n", schemas.T.LongType()),
                                   schemas.T.StructField("extra", schemas.T.StringType())])
    df = spark.createDataFrame([("x", "1"), ("toolong", "2"), (None, "3"), ("y", "z"), ("w", None)], "a string, n string")
    accepted, rejected = contract.conform(df, schema, {"a": 3}, load_time=False)
    assert accepted.dtypes == [("a", "string"), ("n", "bigint"), ("extra", "string")]
    assert sorted(tuple(r) for r in accepted.collect()) == [("w", None, None), ("x", 1, None)]
    assert sorted(r["reject_reason"] for r in rejected.collect()) == ["a is missing", "a is too long", "n is not bigint"]


def test_tables_views_and_inventory(spark):
    catalog.create_schema(spark, "tw_test")
    try:
        df = spark.range(5).withColumn("v", F.lit("x"))
        sinks.write_table(df, "tw_test.plain")
        sinks.write_table(df.limit(2), "tw_test.plain")
        sinks.write_table(df, "tw_test.bucketed", bucket_by="id", buckets=2)
        sinks.create_view(df, "tw_view")
        listed = [tuple(r) for r in catalog.table_inventory(spark, ["tw_test"]).collect()]
        assert listed == [("tw_test", "bucketed", 5), ("tw_test", "plain", 2)]
        catalog.drop_table(spark, "tw_test.plain")
        assert catalog.table_inventory(spark, ["tw_test"]).count() == 1
        with pytest.raises(ValueError):
            sinks.write_table(df, "/tmp/x/y", bucket_by="id", buckets=2)
    finally:
        catalog.drop_schema(spark, "tw_test")


def test_bucketed_tables_join_without_a_shuffle(spark):
    catalog.create_schema(spark, "tw_buckets")
    try:
        for name in ("a", "b"):
            sinks.write_table(spark.range(2000).withColumn(name, F.col("id") * 2), f"tw_buckets.{name}", bucket_by="id", buckets=4)
        joined = spark.table("tw_buckets.a").join(spark.table("tw_buckets.b").hint("merge"), "id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        assert joined.count() == 2000
    finally:
        catalog.drop_schema(spark, "tw_buckets")


def test_append_conformed(spark, folder):
    df = spark.createDataFrame([("p", "c")] * 5, "prompt string, completion string").repartition(3)
    for _ in range(2):
        sinks.append_conformed(df, folder + "/pairs", schemas.TRAINING_PAIRS, identity="sample_id")
    stored = spark.read.parquet(folder + "/pairs")
    assert stored.columns == ["sample_id", "prompt", "completion", "loaded_at"]
    assert stored.count() == stored.select("sample_id").distinct().count() == 10


def test_function_and_file_inventory(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("12345")
    (tmp_path / "sub" / "b.txt").write_text("1")
    found = files.file_inventory(spark, str(tmp_path)).collect()
    assert [(r["name"].rsplit("/", 1)[1], r["size"]) for r in found] == [("a.txt", 5), ("b.txt", 1)]
    assert catalog.function_inventory(spark, "default").columns == ["function_schema", "function_name"]


def test_rows_in_memory(spark):
    df = files.rows_to_table(spark, [(i, "t") for i in range(100)], "k long, t string")
    assert df.count() == 100 and df.columns == ["k", "t"]


def csv_text(seed, n, ending="\n"):
    choose = random.Random(seed)
    cell = lambda: choose.choice(["", "plain", '""', '"a,b"', f'"line one{ending}line ""two"", é"', f'"{ending}{ending}"', '"x""y"', "😀", f'"{ending * choose.randint(1, 60)}"'])
    rows = [",".join([str(i), cell(), cell()]) for i in range(n)]
    rows.insert(n // 2, "")
    rows.insert(n // 3, "7,too,many,cells")
    return ending.join(["k,a,b", *rows]) + choose.choice(["", ending])


@pytest.mark.parametrize("seed, ending", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_a_split_file_gives_the_rows_of_a_whole_one(spark, tmp_path, seed, ending):
    """Line breaks in quotes, over many splits of one file, some of which lie in one value as a whole."""
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(2):
        (folder / f"{i}.csv").write_bytes(csv_text(seed * 10 + i, 300, ending).encode())
    (folder / "only.csv").write_bytes(b"k,a,b")
    schema = T.StructType.fromDDL("k int, a string, b string")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("300", "10000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            whole, by_splits = (files.read_csv(spark, str(folder), schema, split=split) for split in (False, True))
            for a, b in zip(whole, by_splits):
                assert collections.Counter(map(tuple, b.drop("loaded_at").collect())) == collections.Counter(map(tuple, a.drop("loaded_at").collect()))
            if size == "300":
                assert by_splits.accepted.rdd.getNumPartitions() > 20 > whole.accepted.rdd.getNumPartitions()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert whole.rejected.count() == 2
