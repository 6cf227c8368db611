import random
from collections import defaultdict

from pyspark.sql import functions as F

from textmart.operators import maintained as K

PAIRS, TOUCHED = "g STRING, e LONG, g2 STRING", "e LONG"


def test_ten_batches_equal_counting_anew(spark, tmp_path):
    rng = random.Random(3)
    store, now = str(tmp_path / "store"), {}
    for batch in range(10):
        touched = [rng.choice([rng.randrange(50), 32_767, 32_768, 10**12 + rng.randrange(5)]) for _ in range(25)]
        pairs = [(g, e, "x") for e in touched for g in rng.sample(["a", "b", "c", "hot"], rng.randrange(0, 3)) + ["hot"] * (rng.random() < 0.7)]
        # Repeats, NULLs and an entity that is not touched.
        more = [*pairs[:3], (None, touched[0], "x"), ("a", None, "x"), ("a", 77, "x")]
        args = spark.createDataFrame([(e,) for e in [*touched, None]], TOUCHED), spark.createDataFrame([*pairs, *more], PAIRS)
        K.apply_batch(store, batch, *args, "g", "e")
        K.apply_batch(store, batch, *args, "g", "e")
        now |= {e: {g for g, f, _ in pairs if f == e} for e in touched}
        if batch in (4, 5):
            K.compact(spark, store)
            K.compact(spark, store)
        if batch in (0, 5, 9):
            want = defaultdict(int)
            for groups in now.values():
                for g in groups:
                    want[g] += 1
            assert {r.grp: r.n for r in K.counts(spark, store).collect()} == want
            assert K.total(spark, store) == sum(bool(g) for g in now.values())


def test_nothing_yet_and_an_uncommitted_batch(spark, tmp_path):
    store = str(tmp_path / "store")
    assert K.counts(spark, store).collect() == [] and K.total(spark, store) == 0
    empty = spark.createDataFrame([], TOUCHED), spark.createDataFrame([], PAIRS)
    K.apply_batch(store, 0, *empty, "g", "e")
    one = spark.createDataFrame([("a", 1, "")], PAIRS)
    K.bitmaps(one.selectExpr("g AS grp", "e AS entity"), "grp").write.parquet(f"{store}/changes/batch_id=1")
    assert K.counts(spark, store).collect() == []


def test_bitmaps_sort_no_rows(spark):
    """Bitmaps are as Spark's own aggregate makes them, without its sort of all rows."""
    pairs = spark.range(0, 200_000, 1, 4).selectExpr("CAST(id % 3 AS STRING) AS grp", "(id * id) % 100000 AS entity")
    made = K.bitmaps(pairs, "grp")
    native = pairs.groupBy("grp", F.floor(F.col("entity") / K.STRETCH).alias("stretch")).agg(
        F.bitmap_construct_agg(F.pmod("entity", F.lit(K.STRETCH))).alias("bits")
    )
    rows = lambda df: sorted((r.grp, r.stretch, bytes(r.bits)) for r in df.collect())
    assert rows(made) == rows(native)
    plan = made._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "SortAggregate" not in plan and "Sort [" not in plan


def test_rows_of_a_batch_do_not_meet(spark, tmp_path, monkeypatch):
    """Pairs of entities that are not touched are left out by bits; the frames are not joined."""
    seen, frame = [], type(spark.range(1))
    join = frame.join
    monkeypatch.setattr(frame, "join", lambda a, b, on=None, how=None: (seen.append(on), join(a, b, on, how))[1])
    touched = spark.createDataFrame([(1,), (2,), (70_000,)], TOUCHED)
    pairs = spark.createDataFrame([("a", 1, ""), ("a", 3, ""), ("b", 70_000, ""), ("b", 500_000, "")], PAIRS)
    K.apply_batch(str(tmp_path), 0, touched, pairs, "g", "e")
    assert "entity" not in seen and ["grp", "stretch"] in seen
    assert {r.grp: r.n for r in K.counts(spark, str(tmp_path)).collect()} == {"a": 1, "b": 1}
    assert K.total(spark, str(tmp_path)) == 2
