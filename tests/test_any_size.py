"""Groups, partitions and streams of any size."""

import itertools
import json
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyworks import schemas, session, sinks
from tallyworks.operators import joins, sampling, sketches, windows
from tallyworks.plans import history
from tallyworks.registry import QUERIES
from tallyworks.streaming import batches

BASE = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(BASE), reason="test tables are not there")


# --- running balances -------------------------------------------------------------


def expected_balance(rows, frame):
    """By key: rows in order, totals added one by one or by whole peers."""
    groups, out = defaultdict(list), Counter()
    for row in rows:
        groups[row[0]].append(row)
    first = lambda v: (v is not None, v or 0)
    for group in groups.values():
        group.sort(key=lambda r: (first(r[1]), first(r[2])))
        total = None
        peers = [[r] for r in group] if frame == "rows" else [list(p) for _, p in itertools.groupby(group, key=lambda r: r[1])]
        for together in peers:
            known = [r[3] for r in together if r[3] is not None]
            total = total if not known else (total or 0) + sum(known)
            out.update((*r, total) for r in together)
    return out


def made_rows(seed, n, days):
    rnd = random.Random(seed)
    keys, values = ["a"] * 6 + ["b", None], [None, 1, 5, -3, 1000]
    rows = [(rnd.choice(keys), rnd.choice(days), i, rnd.choice(values)) for i in range(n)]
    return rows + [("null first", 1, 0, None), ("null first", 2, 1, None), ("null first", 2, 2, 7), ("nulls", 1, 0, None)]


@pytest.mark.parametrize("frame", ["rows", "range"])
@pytest.mark.parametrize("days", [list(range(40)), [1, 1, 1, 1, 2, None], [3]])
def test_balance_over_many_slices(spark, rows, frame, days):
    """Few days make peers that fill several slices, up to a group of peers alone."""
    made = made_rows(len(days), 900, days)
    df = spark.createDataFrame(made, "k string, day int, n int, v long").repartition(7)
    got = windows.running_balance(df, "v", ["k"], ["day"], ["n"], "total", frame)
    assert Counter(rows(got, "k", "day", "n", "v", "total")) == expected_balance(made, frame)


def test_balance_of_all_rows_and_of_none(spark, rows):
    df = spark.range(500).select((F.col("id") % 3).alias("d"), "id", F.lit(2).alias("v"))
    got = windows.running_balance(df, "v", [], ["d"], ["id"], "total", "range")
    assert {r[0]: r[1] for r in rows(got, "d", "total")} == {0: 334, 1: 668, 2: 1000}
    assert windows.running_balance(df.limit(0), "v", ["d"], ["id"], [], "t").count() == 0


def test_balance_of_decimals(spark, rows):
    df = spark.range(300).selectExpr("'k' AS k", "id", "CAST(id AS DECIMAL(12, 2)) / 4 AS v")
    got = windows.running_balance(df, "v", ["k"], ["id"], [], "total")
    assert rows(got.where("id = 299"), "total")[0][0] == sum(range(300)) / 4


@needs_tables
def test_no_window_holds_a_whole_group(spark, plan):
    """What is left above the pinned slices joins them with a small table."""
    for name in ("running_balances", "top_lines_per_flag"):
        text = plan(QUERIES[name](spark, BASE))
        assert "Window" not in text and "Exchange hashpartitioning" not in text, name
    lines = spark.range(1000).selectExpr("'k' AS k", "id", "id AS v")
    made = windows.running_balance(lines, "v", ["k"], ["id"], [], "t")
    slices = made.groupBy("k").count()
    assert slices.first()["count"] == 1000


def test_balance_is_gathered_by_slice(spark, monkeypatch):
    """Every window over rows is partitioned by slice first."""
    seen = []
    pin = session.pin
    monkeypatch.setattr(windows, "pin", lambda df: (seen.append(df._jdf.queryExecution().executedPlan().toString()), pin(df))[1])
    df = spark.range(1000).selectExpr("'k' AS k", "id % 5 AS d", "id", "id AS v")
    windows.running_balance(df, "v", ["k"], ["d"], ["id"], "t", "range")
    assert "Window [sum(v" in seen[0] and "rangepartitioning(k" in seen[0]
    spec = seen[0].split("Window [sum(v")[1].split("\n")[0]
    assert "[_slice#" in spec and "specifiedwindowframe" in spec
    assert all("_slice" in text for text in seen)


# --- first rows ---------------------------------------------------------------------


@pytest.mark.parametrize("k", [1, 37, 1500, 10_000])
def test_first_rows_equal_a_window(spark, rows, k):
    df = spark.range(4000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).when(F.col("id") % 10 < 9, F.lit("cool")).alias("key"),
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("v"), "id",
    )
    order = [F.desc("v"), F.asc("id")]
    assert rows(windows.first_rows(df, ["key"], order, k)) == rows(windows.top_k(df, ["key"], order, k))


# --- stored layouts ---------------------------------------------------------------------


def test_co_bucketed_tables_meet_without_a_shuffle(spark, rows, plan, tmp_path):
    left = spark.range(500).selectExpr("id % 50 AS k", "id AS a")
    right = spark.range(80).selectExpr("id % 60 AS k", "id AS b")
    for df, table in ((left, "cb_left"), (right, "cb_right")):
        sinks.write_bucketed(df, table, "k", 4, str(tmp_path / table))
    met = joins.co_bucketed(spark, "cb_left", "cb_right", "k").groupBy("k").count()
    text = plan(met)
    assert "Exchange" not in text and "SortMergeJoin" in text
    assert rows(met) == rows(left.join(right, "k").groupBy("k").count())
    sinks.write_bucketed(right, "cb_other", "k", 5, str(tmp_path / "cb_other"))
    with pytest.raises(ValueError, match="bucketed"):
        joins.co_bucketed(spark, "cb_left", "cb_other", "k")
    right.write.mode("overwrite").option("path", str(tmp_path / "cb_plain")).saveAsTable("cb_plain")
    assert joins.bucketing(spark, "cb_plain") == (0, ())


@needs_tables
def test_bucketed_query_has_no_exchange(spark, plan):
    assert "Exchange" not in plan(QUERIES["bucketed_join"](spark, BASE))


def test_rerun_leaves_other_partitions_alone(spark, rows, tmp_path):
    path = str(tmp_path / "years")
    df = spark.range(60).selectExpr("id", "cast(2000 + id % 4 AS int) AS year")
    sinks.write_partitioned(df, path, ["year"])

    def files():
        found = spark.read.parquet(path).select("year", F.input_file_name().alias("f"), F.lit(1)).distinct()
        return {(r.year, r.f) for r in found.collect()}

    before = files()
    fixed = df.withColumn("id", F.col("id") + 1000).where("year != 2002")
    for _ in range(2):
        sinks.rerun_partitions(fixed, path, "year", [2001, 2002])
    after = files()
    assert {f for y, f in before if y in (2000, 2003)} == {f for y, f in after if y in (2000, 2003)}
    assert not {f for y, f in before if y == 2001} & {f for _, f in after}
    got = rows(spark.read.parquet(path), "id", "year")
    assert got == sorted([(i, 2000 + i % 4) for i in range(60) if i % 4 in (0, 3)] + [(i + 1000, 2001) for i in range(60) if i % 4 == 1], key=repr)


def test_years_are_pruned_by_the_dimension(spark, rows, plan, tmp_path):
    facts = spark.range(400).selectExpr("cast(make_date(2000 + id % 8, 5, 1) AS timestamp_ntz) AS at", "id AS cents")
    stored = history.store_years(facts, "at", str(tmp_path / "facts"))
    history.calendar(stored).write.parquet(str(tmp_path / "calendar"))
    years = spark.read.parquet(str(tmp_path / "calendar"))
    sales = history.sales_in_years(stored, years, F.col("days") == 366, F.col("cents"))
    assert "dynamicpruningexpression" in plan(sales)
    expected = [(y, 366, 50, sum(i for i in range(400) if 2000 + i % 8 == y)) for y in (2000, 2004)]
    assert rows(sales, "year", "days", "sales", "cents") == expected


@needs_tables
def test_pruned_query_prunes(spark, plan):
    assert "dynamicpruningexpression" in plan(QUERIES["leap_year_sales"](spark, BASE))


@needs_tables
def test_statistics_turn_the_chain_round(spark):
    chain = QUERIES["chain_by_statistics"](spark, BASE)
    text = chain._jdf.queryExecution().optimizedPlan().toString()
    # Printed from the top: the lines join last, what the nation leaves joins first.
    relations = [line.split("analysed_")[1].split("[")[0] for line in text.splitlines() if "analysed_" in line]
    written = [name.split("`")[0] for name in relations]
    assert {w for w in written[:2]} != {"lineitem", "orders"}, text
    joined = [line.strip() for line in text.splitlines() if "Join Inner" in line]
    assert "l_orderkey" in joined[0] and "c_nationkey" in joined[-1]
    assert spark.conf.get("spark.sql.cbo.enabled") == "false"


# --- sketches and samples ---------------------------------------------------------------


def test_merged_sketches_equal_one_sketch(spark, rows):
    df = spark.range(60_000).selectExpr("id % 12 AS month", "id % 7000 AS v")
    parts = session.pin(sketches.sketched(df, ["month"], "v"))
    whole = sketches.merged(parts.withColumn("all", F.lit(1)), ["all"])
    assert rows(whole, "values") == rows(sketches.merged(sketches.sketched(df, [], "v"), []), "values")
    assert abs(rows(whole, "values")[0][0] - 7000) <= 7000 * sketches.relative_error()
    halves = parts.withColumn("half", F.col("month") >= 6)
    assert {r[0] for r in rows(sketches.merged(halves, ["half"]), "half")} == {False, True}
    assert sketches.merged(parts.limit(0), ["month"]).count() == 0


def test_sample_is_the_same_under_any_partitioning(spark, rows):
    df = spark.range(3000).select("id", (F.col("id") % 4).cast("string").alias("lang")).unionByName(
        spark.createDataFrame([(None, "4"), (1, "4"), (2, None)], "id long, lang string")
    )
    drawn = [rows(sampling.bottom_k(df.repartition(n), ["lang"], "id", 9, "s"), "lang", "id") for n in (1, 64)]
    assert drawn[0] == drawn[1] and Counter(r[0] for r in drawn[0]) == {"0": 9, "1": 9, "2": 9, "3": 9, "4": 2, None: 1}
    assert rows(sampling.bottom_k(df, ["lang"], "id", 9, "t"), "lang", "id") != drawn[0]
    # A row that comes in displaces one at most.
    less = rows(sampling.bottom_k(df.where("id != 8 OR id IS NULL"), ["lang"], "id", 9, "s"), "lang", "id")
    assert len(set(drawn[0]) - set(less)) <= 1


def test_large_sample_is_cut_by_slices(spark, rows):
    df = spark.range(5000).select("id", F.lit("x").alias("lang"))
    small = rows(sampling.bottom_k(df, ["lang"], "id", 900), "id")
    large = rows(sampling.bottom_k(df, ["lang"], "id", 2500), "id")
    assert len(large) == 2500 and set(small) < set(large)


# --- streams ---------------------------------------------------------------------------------


def event(user, query="shoes"):
    return json.dumps({
        "ip": "192.0.2.1", "user_id": user, "user_agent": "agent", "session_id": f"s{user}",
        "event_time": "2024-01-01 10:00:00", "event_name": "Search", "channel": "Direct", "metadata": {"query": query},
    })


def arrive(folder, name, lines):
    folder.mkdir(exist_ok=True)
    aside = folder.parent / f"{name}.part"
    aside.write_text("\n".join(lines))
    aside.rename(folder / name)


@pytest.fixture
def job(spark, tmp_path):
    """Runs the job over what has arrived; gives users of good events and dead lines, by batch."""
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        lines = batches.read_lines(spark, str(tmp_path / "in"), schemas.CLICK_EVENT)
        batches.start(lines, "drill", out, checkpoint, True).awaitTermination()
        good = batches.read_batches(spark, out, batches.GOOD, "user_id BIGINT, user_query STRING")
        dead = batches.read_batches(spark, out, batches.DEAD, "line STRING")
        return sorted((r.batch, r.user_id) for r in good.collect()), sorted((r.batch, r.line) for r in dead.collect())

    return run


def test_replayed_batch_is_there_once(spark, job, tmp_path):
    arrive(tmp_path / "in", "a.json", [event(1), event(2)])
    assert job() == ([(0, 1), (0, 2)], [])
    arrive(tmp_path / "in", "b.json", [event(3)])
    job()
    batches.forget_last_commit(spark, str(tmp_path / "checkpoint"))
    assert job() == ([(0, 1), (0, 2), (1, 3)], [])


def test_batch_stopped_while_writing_does_not_count(spark, job, tmp_path):
    arrive(tmp_path / "in", "a.json", [event(1), event(2)])
    job()
    batches.forget_last_commit(spark, str(tmp_path / "checkpoint"))
    folder = tmp_path / "out" / "good" / "batch=0"
    (folder / "_SUCCESS").unlink()
    assert batches.read_batches(spark, str(tmp_path / "out"), batches.GOOD, "user_id BIGINT").count() == 0
    assert job()[0] == [(0, 1), (0, 2)]


def test_dead_letters_keep_every_line(job, tmp_path):
    cut, named, free = event(5)[:-7], event(6).replace('"user_id": 6', '"user_id": "six"'), "no json at all"
    arrive(tmp_path / "in", "a.json", [event(1), cut, event(2), "", named, free])
    good, dead = job()
    assert good == [(0, 1), (0, 2)]
    assert dead == sorted([(0, cut), (0, named), (0, free)])
    arrive(tmp_path / "in", "b.json", [cut])
    assert job() == (good, sorted([*dead, (1, cut)]))


def test_arrays_and_lines_read_alike(job, tmp_path):
    arrive(tmp_path / "in", "a.json", [f"[{event(1)}, {event(2)}]", event(3)])
    assert job() == ([(0, 1), (0, 2), (0, 3)], [])


@needs_tables
def test_all_lines_are_good_or_dead(spark):
    kinds = {r.kind: r.lines for r in QUERIES["dead_letters"](spark, BASE).collect()}
    assert sum(kinds.values()) == spark.read.parquet(f"{BASE}/events.parquet").count() and len(kinds) == 2
