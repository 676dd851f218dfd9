import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tierwatch.functions.decisions import logistic_score, route
from tierwatch.operators import features, triage
from tierwatch.operators.search_index import SearchIndex
from tierwatch.plans import suite_data  # noqa: F401  (it registers the queries)
from tierwatch.plans.registered import QUERIES
from tierwatch.sources import schemas
from tierwatch.streaming import keyed_table, refresh

START = datetime(2024, 1, 1)


def message(i, days, body="report"):
    return (f"m{i}", "a", "b", None, f"subject {i}", body, START + timedelta(days=days), "Legal", "Legal", "CLEAN")


@pytest.fixture
def arrive(spark, folder):
    """Write one file of messages; files are read in the order of arrival."""
    count = iter(range(100))

    def write(rows):
        path = f"{folder}/in/{next(count):03d}"
        spark.createDataFrame(rows, schemas.MESSAGES).coalesce(1).write.parquet(path)

    return write


def source(spark, folder):
    return refresh.parquet_stream(spark, folder + "/in/*", schemas.MESSAGES, files_per_batch=1)


def keep(df):
    return df.select("email_id", "sent_at")


def run(spark, folder, delay, transform=keep):
    return refresh.append_refresh(source(spark, folder), transform, folder + "/out", folder + "/check",
                                  ["email_id"], "sent_at", delay, state_partitions=2)


def stored(spark, folder):
    return sorted(r["email_id"] for r in spark.read.parquet(folder + "/out").collect())


def test_each_message_once_over_batches_and_runs(spark, folder, arrive):
    arrive([message(1, 0), message(2, 0), message(1, 0)])
    arrive([message(2, 0.1), message(3, 0.2)])
    first = run(spark, folder, "1 day")
    assert first.rows_in == 5 and first.batches == 2 and first.rows_dropped_late == 0
    assert run(spark, folder, "1 day").rows_in == 0
    arrive([message(3, 0.2), message(4, 0.3)])
    assert run(spark, folder, "1 day").rows_in == 2
    assert stored(spark, folder) == ["m1", "m2", "m3", "m4"]


@pytest.mark.parametrize("delay,kept,late", [("1 hour", ["m1", "m3"], 1), ("60 days", ["m1", "m2", "m3"], 0)])
def test_late_rows_are_counted_or_kept(spark, folder, arrive, delay, kept, late):
    arrive([message(1, 20)])
    arrive([message(3, 21)])
    arrive([message(2, 1)])
    report = run(spark, folder, delay)
    assert stored(spark, folder) == kept and report.rows_dropped_late == late


def test_a_very_frequent_key_leaves_before_the_shuffle(spark, folder, arrive):
    arrive([message(7, 0.001 * i) for i in range(300)] + [message(i, 0) for i in range(5)])
    run(spark, folder, "1 day")
    assert stored(spark, folder) == [f"m{i}" for i in (0, 1, 2, 3, 4, 7)]
    batch = spark.read.parquet(folder + "/in/*").withColumn("_event_time", F.col("sent_at").cast("timestamp")).coalesce(1)
    kept = refresh._once_in_batch(batch, ["email_id"]).collect()
    assert len(kept) == 6
    assert [r["sent_at"] for r in kept if r["email_id"] == "m7"] == [START + timedelta(days=0.299)]


def test_stream_triage_equals_batch(spark, folder, arrive):
    rows = [message(i, i / 100, "merger tip before announcement" if i % 3 else "meeting schedule") for i in range(12)]
    for part in range(3):
        arrive(rows[part * 4: part * 4 + 4])

    def decide(df):
        found = features.message_features(df)
        score = logistic_score(["mnpi_risk_score", "baseline_similarity"], [6, -6], -1)
        return triage.decide(found.withColumn("predict_proba_1", score)).select(
            "email_id", "sent_at", "violation_probability", "ml_decision", route(F.col("ml_decision")).alias("action"))

    run(spark, folder, "1 day", decide)
    batch = decide(spark.createDataFrame(rows, schemas.MESSAGES))
    streamed = spark.read.parquet(folder + "/out")
    assert streamed.count() == 12 and streamed.exceptAll(batch).count() == 0
    assert len({r["ml_decision"] for r in batch.collect()}) > 1


def test_a_stored_model_scores_a_stream(spark, folder, arrive):
    from tierwatch.operators import classifier
    columns = ["mnpi_risk_score", "baseline_similarity"]
    rows = [message(i, i / 100, "merger tip" if i % 3 else "meeting schedule") for i in range(12)]
    labelled = features.message_features(spark.createDataFrame(rows, schemas.MESSAGES)).withColumn(
        "is_violation", (F.col("body") == "merger tip").cast("int")).cache()
    model = classifier.train(labelled, columns, n_trees=2, depth=2)
    arrive(rows)
    run(spark, folder, "1 day", lambda df: classifier.score(model, features.message_features(df)).select("email_id", "sent_at", "predict_proba_1"))
    expected = {r["email_id"]: r["predict_proba_1"] for r in classifier.score(model, labelled).collect()}
    assert {r["email_id"]: r["predict_proba_1"] for r in spark.read.parquet(folder + "/out").collect()} == pytest.approx(expected)
    labelled.unpersist()


def test_index_refresh_by_batches(spark, folder, arrive):
    rows = [message(i, i / 100, f"word{i} common") for i in range(9)]
    index = SearchIndex(folder + "/search", "m", "email_id", "body", "subject", ["sender_dept"], buckets=4)

    def refreshed():
        return refresh.refresh_index(source(spark, folder), index, folder + "/check", "sent_at", state_partitions=2)

    arrive(rows[:4])
    arrive(rows[2:6])  # two repeats
    refreshed()
    assert index.lexical_search(spark, "common", 100).count() == 6
    assert index.lexical_search(spark, "word7", 5).count() == 0
    arrive(rows[6:])
    assert refreshed().rows_in == 3 and refreshed().rows_in == 0
    assert [r["email_id"] for r in index.lexical_search(spark, "word7", 5).collect()] == ["m7"]
    # The batches together rank as one index built at once.
    whole = SearchIndex(folder + "/whole", "m", "email_id", "body", "subject", ["sender_dept"], buckets=4)
    whole.refresh(spark.createDataFrame(rows, schemas.MESSAGES), 0)
    for query in ("common", "word3 common", "subject"):
        a, b = (x.search(spark, query, 5).collect() for x in (index, whole))
        assert a == b


def test_the_report_counts_every_batch(spark, folder, arrive):
    """More batches than Spark keeps progress records of."""
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i in range(6):
            arrive([message(i, i / 10)])
        found = run(spark, folder, "1 day")
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert (found.batches, found.rows_in) == (6, 6)


def test_no_text_goes_through_the_state(spark, folder, arrive):
    arrive([message(1, 0)])
    plan = refresh.first_of_each(keep(source(spark, folder)), ["email_id"], "sent_at")._jdf.queryExecution().logical().toString()
    above, below = plan.split("MapInArrow", 1)
    assert "DeduplicateWithinWatermark" in above and "body" not in above and "body" in below


HOUR = timedelta(hours=1)


def plain_table(batches, keep, delay=None):
    """Rows by key and late rows of batches of (key, time, value)."""
    rows, late, newest = {}, [], None
    for batch in batches:
        horizon = newest - delay if newest and delay else None
        for key, at, value in batch:
            if horizon and at < horizon:
                late.append((key, at, value))
                continue
            rows.setdefault(key, set()).add((at, value))
        newest = max([at for _, at, _ in batch] + [newest] * bool(newest))
    pick = max if keep == "latest" else min
    return {k: pick(at for at, _ in v) for k, v in rows.items()}, rows, sorted(late)


@pytest.mark.parametrize("keep", ["latest", "earliest"])
def test_a_keyed_table_does_not_depend_on_batches(spark, folder, keep):
    choose = random.Random(5)
    rows = [(f"k{choose.randint(0, 30)}", START + choose.randint(0, 40) * HOUR, choose.choice("abc")) for _ in range(150)]
    rows += [("hot", START + HOUR, "a")] * 60
    found = []
    for size in (210, 70, 35):
        table = keyed_table.KeyedTable(f"{folder}/{size}", ["id"], "at", keep, buckets=4)
        for n, i in enumerate(range(0, len(rows), size)):
            df = spark.createDataFrame(rows[i:i + size] + [(None, START, "x"), ("n", None, "x")], "id string, at timestamp_ntz, value string")
            table.upsert(df.repartition(3), n)
        found.append(sorted(map(tuple, table.rows(spark).select("id", "at", "value").collect())))
        state = table.version(spark)
        assert (state.rows_in, state.stored, state.repeats, state.late) == (210, len(found[0]), 210 - len(found[0]), 0)
        choose.shuffle(rows)
    times, values, _ = plain_table([rows], keep)
    assert found[0] == found[1] == found[2]
    assert {k: at for k, at, _ in found[0]} == times and all((at, v) in values[k] for k, at, v in found[0])


def test_late_rows_stay_readable_and_nothing_else_is_lost(spark, folder):
    table = keyed_table.KeyedTable(folder, ["id"], "at", delay=10 * HOUR, buckets=8)
    batches = [[("a", START + 20 * HOUR, "1"), ("b", START, "2")], [("c", START + 5 * HOUR, "3"), ("a", START + 12 * HOUR, "4"), ("d", START + 10 * HOUR, "5")],
               [("b", START + 40 * HOUR, "6")], [("e", START + 29 * HOUR, "7"), ("e", START + 29 * HOUR, "7"), ("b", START + 41 * HOUR, "8")]]
    schema = "id string, at timestamp_ntz, value string"
    for n, rows in enumerate(batches):
        table.upsert(spark.createDataFrame(rows, schema), n)
        if n == 1:
            assert [(r.id, r.change) for r in table.changes(spark, 1).collect()] == [("d", "insert")]
    times, _, late = plain_table(batches, "latest", 10 * HOUR)
    assert {r.id: r["at"] for r in table.rows(spark).collect()} == times
    assert sorted((r.id, r["at"], r.value) for r in table.late_rows(spark).collect()) == late and len(late) == 3
    state = table.version(spark)
    assert state.rows_in == 9 == state.stored + state.repeats + state.late
    assert [(r.id, r.value, r.change) for r in table.changes(spark, 3).collect()] == [("b", "8", "update")]
    # A batch that is tried again changes nothing, and a batch touches its own buckets only.
    assert table.upsert(spark.createDataFrame(batches[3], schema), 3) == state
    before = table.version(spark).folders
    after = table.upsert(spark.createDataFrame([("b", START + 50 * HOUR, "9")], schema), 4).folders
    assert len(before) > 1 and sum(before[b] != after[b] for b in before) == 1


def test_a_stream_follows_changes(spark, folder, arrive):
    """A message that comes again with another text gets new features; a second run finds nothing to do."""
    table = keyed_table.KeyedTable(folder + "/table", ["email_id"], "sent_at", delay=timedelta(days=30), buckets=4)

    def follow():
        return keyed_table.follow(source(spark, folder), lambda df: df.select("email_id", "sent_at", F.length("body").alias("n")), table, folder + "/check")

    arrive([message(1, 40, "report"), message(2, 40, "report")])
    arrive([message(1, 41, "a longer report"), message(3, 41)])
    arrive([message(2, 1, "much too late"), message(1, 39, "older than that")])
    report = follow()
    assert (report.rows_in, report.rows_dropped_late) == (6, 1) and follow().rows_in == 0
    assert {r.email_id: r.n for r in table.rows(spark).collect()} == {"m1": 15, "m2": 6, "m3": 6}
    assert [(r.email_id, r.n) for r in table.late_rows(spark).collect()] == [("m2", 13)]
    arrive([message(3, 42, "")])
    assert follow().batches == 1 and {r.email_id: r.n for r in table.rows(spark).collect()}["m3"] == 0


@pytest.mark.parametrize("name", ["stream_features", "index_bulk_then_stream"])
def test_a_table_that_is_a_folder_of_files_streams_as_one_file_does(spark, folder, name):
    sf = "/root/testdata/sf0.001"
    for table in ("documents", "events"):
        spark.read.parquet(f"{sf}/{table}.parquet").repartition(3).write.parquet(f"{folder}/{table}.parquet")
    found, wanted = (sorted(map(str, QUERIES[name](spark, d).collect())) for d in (folder, sf))
    assert found == wanted and found
