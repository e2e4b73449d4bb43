import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyworks.operators import aggregates, joins, shaping, windows

SLOW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


# --- joins ------------------------------------------------------------------------


def test_matched_and_unmatched(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k INT, v STRING")
    right = spark.createDataFrame([(2,), (2,), (3,), (None,)], "k INT")
    assert rows(joins.matched(left, right, "k")) == [(2, "b"), (2, "c")]
    assert rows(joins.unmatched(left, right, "k")) == [(1, "a"), (None, "d")]
    assert rows(joins.unmatched(left, right.limit(0), "k")) == rows(left)


def test_matched_reduces_the_tested_side_before_its_shuffle(spark, plan):
    left = spark.range(100).withColumnRenamed("id", "k")
    right = spark.range(1000).select((F.col("id") % 3).alias("k"))
    text = plan(joins.unmatched(left, right, "k"))
    # Joined, final and partial distinct, in this order from the top.
    assert "LeftAnti" in text and text.count("HashAggregate") == 2


@pytest.mark.parametrize("bits", [64, 1 << 23])
def test_sifted_rows_lose_no_key_and_are_not_shuffled(spark, rows, plan, monkeypatch, bits):
    """Negative and null keys, repeated rows, a filter that is nearly full."""
    monkeypatch.setattr(joins, "FILTER_BITS", bits)
    rng = random.Random(4)
    keys = [rng.getrandbits(64) - (1 << 63) for _ in range(300)] + [-1, 0, 63, -64, None]
    made = [(k, f"text {n % 3}") for n, k in enumerate(keys + keys[:40])]
    known = set(keys[:20] + keys[-5:-1])
    df = spark.createDataFrame(made, "k LONG, v STRING")
    may, stays = joins.sifted(df, "k", spark.createDataFrame([(k,) for k in [*known, None]], "k LONG"))
    assert rows(may.unionByName(stays)) == sorted(made, key=repr)
    assert known.isdisjoint({k for k, _ in rows(stays)})
    assert known <= {k for k, _ in rows(may)} and None not in {k for k, _ in rows(may)}
    if bits > 64:
        assert {k for k, _ in rows(may)} == known
    assert "BroadcastHashJoin" in plan(stays) and "SortMergeJoin" not in plan(stays)


def test_lookup_leaves_the_choice_to_the_planner(spark, plan):
    facts = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    names = spark.range(10).select(F.col("id").alias("k"), F.lit("n").alias("name"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit, found in (("10MB", True), ("-1", False)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            assert ("BroadcastHashJoin" in plan(joins.lookup(facts, names, "k"))) == found
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_skewed_lookup_is_split_at_run_time(spark, plan, tmp_path, rows):
    """A key with most rows, against a side too large to broadcast."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 40_000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id") % 500).alias("k"),
            F.xxhash64("id").alias("v"),
        )
        names = spark.range(500).select(F.col("id").alias("k"), F.col("id").cast("string").alias("n"))
        for joined in (joins.lookup(facts, names, "k"), joins.large_join(facts, names, "k")):
            assert len(joined.collect()) == 40_000
            assert "skew=true" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# --- aggregates ---------------------------------------------------------------------


def test_distinct_count_takes_null_as_a_value(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v STRING")
    assert rows(aggregates.distinct_count(df, "v", "n")) == [(2,)]
    assert rows(aggregates.distinct_count(df.limit(0), "v", "n")) == [(0,)]


def test_share_by(spark, rows):
    df = spark.createDataFrame([(1, True), (1, False), (1, None), (2, False)], "k INT, hit BOOLEAN")
    shared = aggregates.share_by(df, ["k"], F.col("hit"), "hits", "n", "pct", digits=2)
    assert rows(shared) == [(1, 1, 3, 33.33), (2, 0, 1, 0.0)]


def test_one_per_key_keeps_whole_rows(spark, rows):
    df = spark.createDataFrame(
        [(1, "b", 1), (1, "a", 9), (None, "x", 1), (None, "y", 0), (2, None, 3)],
        "k INT, v STRING, n INT",
    )
    assert rows(aggregates.one_per_key(df, ["k"], ["v"])) == [
        (1, "a", 9), (2, None, 3), (None, "x", 1),
    ]
    assert rows(aggregates.one_per_key(df, ["k"], ["n"])) == [
        (1, "b", 1), (2, None, 3), (None, "y", 0),
    ]
    assert aggregates.one_per_key(df, ["k"]).columns == df.columns
    assert rows(aggregates.one_per_key(df.select("k"), ["k"])) == [(1,), (2,), (None,)]


def test_nest_makes_one_row_per_small_key(spark, rows):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", None), (None, 5)], "k STRING, v INT")
    nested = aggregates.nest(df, ["k"], ["v"], "vs")
    assert rows(nested.select("k", "part", "vs.v")) == [
        ("a", 0, [1, 2]), ("b", 0, [None]), (None, 0, [5]),
    ]


def test_nest_parts_come_from_content_and_lose_nothing(spark, rows, plan):
    # One key, and one group of equal copies, hold most rows.
    df = spark.range(0, 3000, 1, 5).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 > 0, F.lit(None)).otherwise(
            F.concat(F.lit("k"), F.col("id"))
        ).alias("k"),
        F.when(F.col("id") % 3 == 1, F.lit(1)).otherwise(F.col("id")).alias("v"),
        "id",
    )
    nested = aggregates.nest(df, ["k"], ["v"], "vs", part_by=F.pmod(F.xxhash64("id"), F.lit(20)))
    assert plan(nested).count("Exchange") == 1
    assert rows(nested.select("k", F.explode("vs.v"))) == rows(df, "k", "v")
    sizes = nested.select("k", "part", F.size("vs").alias("n"))
    assert sizes.where("k = 'hot'").count() == 20
    assert sizes.agg(F.max("n")).first()[0] < 200
    # The same rows make the same parts, however many others there are.
    some = aggregates.nest(df.where("k LIKE 'k%'"), ["k"], ["v"], "vs", F.pmod(F.xxhash64("id"), F.lit(20)))
    assert rows(some) == rows(nested.where("k LIKE 'k%'"))


@SLOW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=30),
       st.integers(1, 5))
def test_nest_then_explode_is_identity(spark, rows, data, parts):
    df = spark.createDataFrame(data, "k STRING, v INT")
    nested = aggregates.nest(df, ["k"], ["v"], "vs", F.pmod("v", F.lit(parts)))
    assert rows(nested.select("k", F.explode("vs.v"))) == rows(df)


def test_nested_under_keeps_parents_without_children(spark, rows):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "k INT")
    children = spark.createDataFrame([(1, i) for i in range(10)] + [(2, 1), (None, 1), (9, 1)], "k INT, v INT")
    nested = aggregates.nested_under(
        parents, children, ["k"], ["v"], "vs", summary=[F.avg("v").alias("m")], part_by=F.col("v") % 4
    )
    flat = nested.select("k", "m", F.explode_outer("vs.v").alias("v"))
    assert rows(flat) == sorted(
        [(1, 4.5, i) for i in range(10)] + [(2, 1.0, 1), (3, None, None)], key=repr
    )
    assert nested.where("k = 1").count() > 1


def test_sums_through_equals_join_then_sum(spark, rows):
    facts = spark.createDataFrame([(1, 5), (1, None), (2, 7), (9, 1), (None, 3)], "k INT, v INT")
    names = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "k INT, n STRING")
    through = aggregates.sums_through(
        facts, names, "k", ["n"], {"total": F.sum("v"), "rows": F.count("*"), "known": F.count("v")}
    )
    plain = facts.join(names, "k").groupBy("n").agg(F.sum("v"), F.count("*"), F.count("v"))
    assert rows(through) == rows(plain) == [("x", 12, 3, 2)]


def test_partition_profile(spark):
    df = spark.range(0, 100, 1, 4)
    profile = aggregates.partition_profile(df).collect()
    assert len(profile) == 4 and sum(row["count"] for row in profile) == 100


def test_catalogue_ends_and_cube(spark, rows):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 6.0), ("b", 5.0, None)], "k STRING, x DOUBLE, y DOUBLE")
    stats = {row["k"]: row for row in aggregates.catalogue(df, ["k"], "x", "y").collect()}
    assert stats["a"]["var_samp"] == 2.0 and stats["a"]["corr"] == pytest.approx(1.0)
    assert stats["b"]["count"] == 1 and stats["b"]["stddev_samp"] is None
    assert rows(aggregates.ends_by(df, [], "k", ["x"])) == [("a", "b", ["a", "b"])]
    cube = aggregates.cube_counts(df, "k", "y")
    assert (None, None, 1, 1, 3, 3) in rows(cube)


# --- windows ------------------------------------------------------------------------


def test_running_total_frames(spark, rows):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 10), ("a", 2, 20), ("b", 1, 5)], "k STRING, o INT, v INT")
    by_range = windows.running_total(df, "v", ["k"], ["o"], "t", frame="range")
    assert rows(by_range, "k", "o", "t") == [("a", 1, 1), ("a", 2, 31), ("a", 2, 31), ("b", 1, 5)]
    by_rows = rows(windows.running_total(df, "v", ["k"], ["o"], "t"), "k", "o", "t")
    assert by_rows[0] == ("a", 1, 1) and by_rows[3] == ("b", 1, 5)
    assert {total for _, _, total in by_rows[1:3]} in ({11, 31}, {21, 31})


def test_top_k_breaks_ties_and_limits_before_the_shuffle(spark, rows, plan):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 9), ("b", 4, 1)], "k STRING, id INT, n INT")
    top = windows.top_k(df, ["k"], [F.desc("n"), F.asc("id")], 2)
    assert rows(top, "k", "id", "rank") == [("a", 1, 2), ("a", 3, 1), ("b", 4, 1)]
    text = plan(top)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


@SLOW
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5)), max_size=40), st.integers(1, 4))
def test_top_k_is_sort_and_slice(spark, rows, data, k):
    numbered = [(key, value, i) for i, (key, value) in enumerate(data)]
    df = spark.createDataFrame(numbered, "k INT, v INT, id INT")
    expected = []
    for key in {key for key, _, _ in numbered}:
        group = sorted((r for r in numbered if r[0] == key), key=lambda r: (-r[1], r[2]))
        expected += [(*row, place + 1) for place, row in enumerate(group[:k])]
    top = windows.top_k(df, ["k"], [F.desc("v"), F.asc("id")], k)
    assert rows(top) == sorted(expected, key=repr)


def test_ranked_equals_row_number_over_hot_and_null_keys(spark, rows):
    generator = random.Random(7)
    data = [
        (generator.choice(["hot", "hot", "hot", "x", "y", None]), generator.randint(0, 20), i)
        for i in range(3000)
    ]
    df = spark.createDataFrame(data, "k STRING, v INT, id INT").repartition(7)
    order = [F.desc("v"), F.asc("id")]
    expected = df.withColumn(
        "ranking", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("long")
    )
    ranked = windows.ranked(df, ["k"], order)
    assert rows(ranked) == rows(expected)
    assert ranked.columns == expected.columns


def test_ranked_of_nothing(spark):
    df = spark.createDataFrame([], "k STRING, id INT")
    assert windows.ranked(df, ["k"], [F.asc("id")]).count() == 0


# --- shaping --------------------------------------------------------------------------


def test_typed_and_rejects(spark, rows):
    df = spark.createDataFrame([("1", "a.b"), ("x", None), (None, "c")], "n STRING, `o.p` STRING")
    types = {"n": "int", "o.p": "string"}
    assert rows(shaping.typed(df, types)) == [(1, "a.b"), (None, "c"), (None, None)]
    assert rows(shaping.rejects(df, types)) == [(1, 0)]


def test_united_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x")], "a INT, b STRING")
    b = spark.createDataFrame([("y", 2), ("x", 1)], "b STRING, a INT")
    assert rows(shaping.united(a, b)) == [(1, "x"), (1, "x"), (2, "y")]
    assert rows(shaping.united(a, b.drop("b"), allow_missing=True)) == [(1, "x"), (1, None), (2, None)]
    with pytest.raises(Exception):
        shaping.united(a, b.drop("b")).collect()


def test_unnested_drops_empty_and_null_arrays(spark, rows):
    df = spark.createDataFrame(
        [(1, [(1, "a"), (2, "b")]), (2, []), (3, None)], "id INT, xs ARRAY<STRUCT<q: INT, t: STRING>>"
    )
    assert rows(shaping.unnested(df, "xs", ["q", "t"])) == [(1, 1, "a"), (1, 2, "b")]


def test_catalogue_of_a_column_that_does_not_vary(spark):
    df = spark.createDataFrame(
        [("same", 2.0, 1), ("same", 2.0, 5), ("one", 3.0, 1), ("none", None, 1), ("line", 1.0, 2),
         ("line", 2.0, 4), ("line", 9.0, None)],
        "k string, x double, y int",
    )
    got = {r.k: r["corr"] for r in aggregates.catalogue(df, ["k"], "x", "y").collect()}
    assert got["line"] == pytest.approx(1.0)
    assert got["same"] is None and got["one"] is None and got["none"] is None
