import random
from datetime import datetime

from pyspark.sql import functions as F

from textmart.operators.incremental import first_seen, take_while
from textmart.streaming import first_seen as SF
from textmart.streaming import upserts as SU
from textmart.streaming.take_while import stream_take_while


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


PAGES = [(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, ["c", "d", "d"]), (4, ["a", "e", "x"])]


def test_first_seen_over_restarts_equals_one_batch(spark, tmp_path):
    schema = "page INT, ids ARRAY<STRING>"
    known = spark.createDataFrame([("x",)], "job_id STRING")
    feed, store, checkpoint = (str(tmp_path / n) for n in ("feed", "store", "checkpoint"))
    for page in PAGES:
        spark.createDataFrame([page], schema).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(schema).parquet(feed)
        SF.stream_first_seen(stream, "ids", "page", store, checkpoint, existing=known)
    batch = first_seen(spark.createDataFrame(PAGES, schema), "ids", "page").where("job_id <> 'x'")
    assert rows(SF.read_store(spark, store).select("job_id", "page")) == rows(batch)


def test_a_replayed_batch_overwrites_itself(spark, tmp_path):
    schema = "page INT, ids ARRAY<STRING>"
    feed, store = str(tmp_path / "feed"), str(tmp_path / "store")
    spark.createDataFrame(PAGES, schema).write.parquet(feed)
    for run in ("one", "two"):
        # A new checkpoint makes the same input batch 0 again.
        stream = spark.readStream.schema(schema).parquet(feed)
        SF.stream_first_seen(stream, "ids", "page", store, str(tmp_path / run))
    batch = first_seen(spark.createDataFrame(PAGES, schema), "ids", "page")
    assert rows(SF.read_store(spark, store).select("job_id", "page")) == rows(batch)


def test_a_new_checkpoint_over_an_old_store(spark, tmp_path):
    """Several batches, then all of them again from the start: nothing is stored twice."""
    schema = "page INT, ids ARRAY<STRING>"
    feed, store = str(tmp_path / "feed"), str(tmp_path / "store")
    for page in PAGES:
        spark.createDataFrame([page], schema).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(schema).parquet(feed)
        SF.stream_first_seen(stream, "ids", "page", store, str(tmp_path / "one"))
    SF.stream_first_seen(spark.readStream.schema(schema).parquet(feed), "ids", "page", store, str(tmp_path / "two"))
    batch = first_seen(spark.createDataFrame(PAGES, schema), "ids", "page")
    assert rows(SF.read_store(spark, store).select("job_id", "page")) == rows(batch)


UPSERT = "job_id STRING, seq INT, title STRING, skills ARRAY<STRING>, created_at TIMESTAMP"
T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1)
BATCHES = [
    [("1", 1, "a", ["x"], T1), ("1", 2, "b", ["x", "y"], T1), ("2", 1, "c", ["z"], T1)],
    [("2", 3, None, [], T2), ("3", 1, "d", ["w"], T2)],
    [("3", 2, "e", ["v"], T2)],
]
FINAL = [("1", 2, "b", ["x", "y"]), ("2", 3, None, []), ("3", 2, "e", ["v"])]


def test_upserts_last_write_wins_with_and_without_snapshot(spark, tmp_path):
    for compact in (False, True):
        base = tmp_path / str(compact)
        feed, store, checkpoint = (str(base / n) for n in ("feed", "store", "checkpoint"))
        for i, batch in enumerate(BATCHES):
            spark.createDataFrame(batch, UPSERT).write.mode("append").parquet(feed)
            stream = spark.readStream.schema(UPSERT).parquet(feed)
            SU.stream_upsert(stream, "job_id", "seq", store, checkpoint)
            if compact and i < 2:
                SU.compact(spark, store, "job_id")
        now = SU.current(spark, store, "job_id")
        assert rows(now.select("job_id", "seq", "title", "skills")) == FINAL
        assert [r[0] for r in now.orderBy("job_id").select("created_at").collect()] == [T1, T1, T2]
        children = SU.children_of(now, "job_id", "skills", "skill")
        assert rows(children) == [("1", "x"), ("1", "y"), ("3", "v")]


def test_uncommitted_changes_are_not_read(spark, tmp_path):
    feed, store = str(tmp_path / "feed"), str(tmp_path / "store")
    spark.createDataFrame(BATCHES[0], UPSERT).write.parquet(feed)
    SU.stream_upsert(spark.readStream.schema(UPSERT).parquet(feed), "job_id", "seq", store, str(tmp_path / "c"))
    before = rows(SU.current(spark, store, "job_id"))
    lost = spark.createDataFrame(BATCHES[1], UPSERT)
    lost.write.parquet(f"{store}/changes/batch_id=1")
    assert rows(SU.current(spark, store, "job_id")) == before
    assert spark.createDataFrame(BATCHES[0], UPSERT).select(F.count("*")).first()[0] == 3


def upsert(spark, store, checkpoint, feed, *batches):
    for batch in batches:
        spark.createDataFrame(batch, UPSERT).write.mode("append").parquet(feed)
        SU.stream_upsert(spark.readStream.schema(UPSERT).parquet(feed), "job_id", "seq", store, checkpoint)


def test_a_new_checkpoint_loses_no_stored_row(spark, tmp_path):
    for compact in (False, True):
        base = tmp_path / str(compact)
        store = str(base / "store")
        upsert(spark, store, str(base / "one"), str(base / "feed1"), *BATCHES)
        if compact:
            SU.compact(spark, store, "job_id")
            SU.compact(spark, store, "job_id")
        more = [("3", 1, "later", [], T2), ("4", 1, "new", ["n"], T2)]
        upsert(spark, store, str(base / "two"), str(base / "feed2"), more)
        want = [*FINAL[:2], ("3", 1, "later", []), ("4", 1, "new", ["n"])]
        assert rows(SU.current(spark, store, "job_id").select("job_id", "seq", "title", "skills")) == want
        # The first stream goes on after the second one wrote, and after another snapshot.
        SU.compact(spark, store, "job_id")
        upsert(spark, store, str(base / "one"), str(base / "feed1"), [("4", 9, "newest", [], T2)])
        want[3] = ("4", 9, "newest", [])
        assert rows(SU.current(spark, store, "job_id").select("job_id", "seq", "title", "skills")) == want


def test_a_batch_is_applied_once_and_an_attempt_that_failed_is_not_read(spark, tmp_path):
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "c")
    upsert(spark, store, checkpoint, str(tmp_path / "feed"), BATCHES[0])
    before = rows(SU.current(spark, store, "job_id"))
    # The same batch again, as after a crash between its commit and the checkpoint's: not written.
    SU._apply(spark.createDataFrame(BATCHES[1], UPSERT), store, checkpoint, 0)
    assert rows(SU.current(spark, store, "job_id")) == before
    # An attempt that began and wrote, but did not commit; another run commits after it.
    SU._commit(spark, store, "begun", 1, "lost", 0)
    spark.createDataFrame(BATCHES[2], UPSERT).write.parquet(f"{store}/changes/batch_id=1")
    upsert(spark, store, str(tmp_path / "other"), str(tmp_path / "feed2"), BATCHES[1])
    now = rows(SU.current(spark, store, "job_id").select("job_id", "seq"))
    assert now == [("1", 2), ("2", 3), ("3", 1)]


def test_first_seen_follows_a_hot_id_and_null_pages(spark, tmp_path):
    schema = "page INT, ids ARRAY<STRING>"
    pages = [(p, ["hot", f"own{p}", None]) for p in range(40, 0, -1)] + [(None, ["nowhere"]), (50, None), (51, [])]
    feed, store = str(tmp_path / "feed"), str(tmp_path / "store")
    spark.createDataFrame(pages, schema).repartition(4).write.parquet(feed)
    SF.stream_first_seen(spark.readStream.schema(schema).parquet(feed), "ids", "page", store, str(tmp_path / "c"))
    want = sorted([("hot", 1)] + [(f"own{p}", p) for p in range(1, 41)], key=repr)
    assert rows(SF.read_store(spark, store).select("job_id", "page")) == want


def test_a_first_batch_that_failed_is_written_again(spark, tmp_path):
    """Its output is there, its commit is not: it must not take its own output for known."""
    import shutil

    schema = "page INT, ids ARRAY<STRING>"
    feed, store, checkpoint = (str(tmp_path / n) for n in ("feed", "store", "c"))
    spark.createDataFrame(PAGES, schema).write.parquet(feed)
    stream = lambda: spark.readStream.schema(schema).parquet(feed)
    SF.stream_first_seen(stream(), "ids", "page", store, checkpoint)
    before = rows(SF.read_store(spark, store))
    for part in ("commits", "state"):
        shutil.rmtree(f"{checkpoint}/{part}")
    SF.stream_first_seen(stream(), "ids", "page", store, checkpoint)
    assert rows(SF.read_store(spark, store)) == before


def test_take_while_in_any_order_of_arrival(spark, tmp_path):
    rng = random.Random(4)
    pages = [(t, p, p != stop and rng.random() < 0.97, f"u{t}-{p}") for t, stop in (("a", 3), ("b", 0), ("c", 99), (None, 5)) for p in range(9)]
    schema = "term STRING, page LONG, full BOOLEAN, url STRING"
    batch = take_while(spark.createDataFrame(pages, schema).withColumn("k", F.coalesce("term", F.lit("-"))), "k", "page", F.col("full"))
    want = rows(batch.select("term", "page", "full", "url"))
    assert want
    for seed in range(2):
        random.Random(seed).shuffle(pages)
        feed, store, checkpoint = (str(tmp_path / f"{n}{seed}") for n in ("feed", "store", "c"))
        # A page that comes again is ignored.
        again = [("a", 0, True, "again"), ("b", 0, True, "again"), ("a", None, True, "no number")]
        for part in (pages[0::3], pages[1::3], pages[2::3], again):
            spark.createDataFrame(part, schema).write.mode("append").parquet(feed)
            stream_take_while(spark.readStream.schema(schema).parquet(feed), "term", "page", F.col("full"), store, checkpoint)
        got = spark.read.parquet(store).select("term", "page", "full", "url")
        assert rows(got) == want
