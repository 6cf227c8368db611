"""Plans that must hold when one key has a third of all rows."""

import pytest
from pyspark.sql import functions as F

from catalogue.queries import QUERIES
from textmart import sizes, sources
from textmart.functions.literals import explode_computed
from textmart.operators import incremental as I
from textmart.operators import marts as M
from textmart.operators import model as O
from textmart.sizes import dealt

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
}


@pytest.fixture
def tight(spark):
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k in SMALL:
        spark.conf.unset(k)


def executed(df):
    """Rows and final physical plan of one execution."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def skewed(spark, n=30_000):
    """A third of the rows have key 0, the others are spread."""
    return spark.range(0, n, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997 + 1).alias("k"),
        F.concat(F.lit("value-"), F.col("id")).alias("v"),
    )


def test_hot_parent_is_split_in_joins(tight):
    left = skewed(tight)
    right = tight.range(0, 998, 1, 4).select(F.col("id").alias("k"), F.lit("p").alias("p"))
    got, plan = executed(M.join_children(right, left, "k"))
    assert len(got) == 30_000 and "skew=true" in plan.replace(" ", "").lower()


def test_hot_id_is_split_in_anti_joins(tight):
    done = tight.range(500, 998, 1, 4).select(F.col("id").alias("k"))
    got, plan = executed(I.not_in(skewed(tight), done, "k"))
    want = skewed(tight).where("k < 500").count()
    assert len(got) == want and "skew=true" in plan.replace(" ", "").lower()


def test_latest_limits_rows_before_the_shuffle(tight):
    got, plan = executed(O.latest(skewed(tight), "k", "v"))
    assert len(got) == 998
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning(k")
    assert "Partial" in plan


def test_group_counts_spread_a_hot_group(spark):
    _, plan = executed(M.entities_per_group(skewed(spark), "k", "v"))
    assert "Exchange hashpartitioning(k#" in plan and "Exchange hashpartitioning(v#" not in plan
    first = plan[plan.rindex("Exchange hashpartitioning") :].split(")")[0]
    assert "k#" in first and "v#" in first


def test_share_shuffles_the_pairs_once(tight):
    got, plan = executed(M.share_of_entities(skewed(tight), "k", "v"))
    assert len(got) == 998 and "ReusedExchange" in plan


def test_first_seen_never_gathers_an_id(spark):
    pages = spark.range(0, 300, 1, 6).select(
        F.col("id").alias("page"),
        F.array(F.lit("hot"), F.lit("hot"), F.col("id").cast("string")).alias("ids"),
    )
    got, plan = executed(I.first_seen(pages, "ids", "page"))
    assert len(got) == 302 and "Window" not in plan and "partial_min_by" in plan
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_computed_arrays_are_computed_once(spark):
    df = spark.createDataFrame([("a b",), ("",)], "t STRING")
    split = df.select("t", F.split(F.upper("t"), " ").alias("words"))
    got, plan = executed(explode_computed(split, ["t"], "words", "w"))
    assert sorted(r["w"] for r in got) == ["", "A", "B"]
    assert plan.split("Initial Plan")[0].count("upper(") == 1


def test_frontier_has_no_join(spark):
    terms = spark.createDataFrame([("a",)], "term STRING")
    _, plan = executed(I.url_frontier(terms, "%s/%d", 3, 10, []))
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_replaced_children_are_not_sorted(tight):
    """More parents than are broadcast; one of them has a third of the children."""
    parents = tight.range(0, 600_000, 1, 4).select(F.col("id").alias("k")).where("k % 2 = 0")
    new = tight.range(0, 60_000, 1, 4).select((F.col("id") % 500).alias("k"), (F.col("id") % 3).cast("string").alias("v"))
    got, plan = executed(O.replace_children(skewed(tight), parents, new, "k", "v"))
    kept = {(r.k, r.v) for r in skewed(tight).where("k % 2 = 1").collect()}
    assert {(r.k, r.v) for r in got} == kept | {(k, str(v)) for k in range(0, 500, 2) for v in range(3)}
    assert len(got) == len(kept) + 750
    final = plan.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in final and "ShuffledHashJoin" in final and "Sort [" not in final
    assert "skew=true" in final.replace(" ", "").lower()


def test_pairs_are_dealt_by_rows(spark):
    """AQE would merge these 40,000 rows, 1 KB compressed, into one task."""
    pairs = spark.range(0, 40_000, 1, 2).select((F.col("id") % 20_000).alias("k"), (F.col("id") % 2).alias("v"))
    tasks = dealt(pairs, "k", "v", rows=1_000).distinct().groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 20_000 and max(r["count"] for r in tasks) < 1_000


def test_query_deals_its_old_children_by_rows(spark):
    _, plan = executed(QUERIES["replace_children"](spark, "/root/testdata/sf0.001"))
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("REPARTITION_BY_NUM") >= 2 and "SortMergeJoin" not in final


def test_insert_ignore_meets_in_tasks_of_rows(tight, monkeypatch):
    monkeypatch.setattr(sizes, "ROWS_PER_TASK", 1_000)
    base = tight.range(0, 30_000, 1, 2).select("id", F.lit("base").alias("v"))
    new = tight.range(20_000, 40_000, 1, 2).select("id", F.lit("new").alias("v"))
    got, plan = executed(O.insert_ignore(base, new.unionAll(new), ["id"]))
    assert sorted((r.id, r.v) for r in got) == [(i, "base" if i < 30_000 else "new") for i in range(40_000)]
    assert "hashpartitioning(id" in plan and ", 70), REPARTITION_BY_NUM" in plan


@pytest.mark.parametrize("name", ["src_cache_last_wins", "src_cache_default_appends"])
def test_appends_are_written_by_as_many_tasks_as_are_read(spark, monkeypatch, name):
    seen, write = [], sources.write_html_csv
    monkeypatch.setattr(sources, "write_html_csv", lambda df, *a, **k: (seen.append(df.rdd.getNumPartitions()), write(df, *a, **k)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20kb")
    try:
        n = QUERIES[name](spark, "/root/testdata/sf0.001").count()
        scans = [spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("pages", "documents")]
        assert n and seen == [max(5, s.rdd.getNumPartitions()) for s in scans] and max(seen) > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
