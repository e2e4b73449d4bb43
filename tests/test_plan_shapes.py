"""The physical plans the queries are meant to have."""

import os

import pytest

from tallyworks.plans import olist, rental, retail
from tallyworks.registry import QUERIES
from tallyworks.stand_ins import Tables

BASE = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="test tables are not there")


@pytest.fixture
def planned(spark, plan):
    return lambda name: plan(QUERIES[name](spark, BASE))


def test_top_k_needs_no_full_sort(planned):
    text = planned("top_locations_good")
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_key_tests_are_semi_and_anti_joins(planned):
    for name in ("never_bought_status_p", "never_bought", "never_labelled"):
        assert "LeftAnti" in planned(name)
    assert planned("buyers_per_nation").count("LeftSemi") == 2


def test_top_per_group_limits_before_the_shuffle(planned):
    for name in ("top_part_per_nation", "top10_parts_per_month"):
        text = planned(name)
        assert text.count("WindowGroupLimit") == 2, name


def test_monthly_tops_count_before_they_meet_the_films(planned):
    """The planner moves a semi join below the counts, and every line would be sorted for it."""
    for name in ("top10_parts_per_month", "repeat_toppers"):
        text = planned(name)
        assert "LeftSemi" not in text and "REPARTITION_BY_NUM" in text, name


def test_one_level_of_counting(planned):
    text = planned("top_part_per_nation")
    assert text.count("functions=[count(product") == 1


PYTHON = {"top_locations_good_udf", "exif_scan", "exif_from_column"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PYTHON))
def test_native_queries_run_no_python(spark, plan, name):
    """Queries that write first are looked at in the plan that reads back what they wrote."""
    text = plan(QUERIES[name](spark, BASE))
    assert "Python" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_year_filter_reaches_the_scan(planned):
    text = planned("monthly_category_summary")
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text


def test_only_named_columns_are_read(planned):
    text = planned("orders_by_status")
    assert "ReadSchema: struct<o_orderstatus:string>" in text
    assert "l_extendedprice" not in planned("products_by_region_nation")


def test_status_filters_reach_the_scan(planned):
    assert "EqualTo(o_orderstatus,F)" in planned("late_rate_by_month")
    assert "EqualTo(o_custkey,148)" in planned("accumulated_monthly_spend")


def test_facts_are_counted_before_their_join(spark):
    counted = Tables(spark, BASE).sales_per_location()
    lines = counted._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(lines) if "Join Inner" in line)
    count = next(i for i, line in enumerate(lines) if "count(1)" in line)
    scan = next(i for i, line in enumerate(lines) if "o_custkey" in line and "Relation" in line)
    assert join < count < scan


def test_country_is_chosen_before_copies_are_joined(spark):
    t = Tables(spark, BASE)
    chosen = rental.category_rentals(t.rental(), t.renters(), t.films(), "NATION_7", t.inventory())
    text = chosen._jdf.queryExecution().optimizedPlan().toString()
    # The join with the lines is above (printed before) the one with the customers.
    joins_at = [line.strip() for line in text.splitlines() if "Join Inner" in line]
    assert "inventory_id" in joins_at[1] and "customer_id" in joins_at[2]


def test_mean_of_means_keeps_two_levels(spark, plan):
    t = Tables(spark, BASE)
    text = plan(olist.customer_average_order(t.items(), t.orders(), ("P",), ordered=False))
    # Partial and final aggregate by order, then by customer; the first level's
    # partitioning serves the join, so the lines are shuffled once.
    assert text.count("HashAggregate(keys=[order_id") == 2
    assert text.count("HashAggregate(keys=[customer_id") == 2
    assert text.count("Exchange hashpartitioning(order_id") == 2


@pytest.mark.parametrize("name", ["rank_desc", "rank_asc"])
def test_ranks_shuffle_rows_once(planned, name):
    """Above the pinned slices the rows meet only the small table of shifts."""
    text = planned(name)
    assert "Exchange hashpartitioning" not in text and "Sort" not in text and "Window" not in text
    assert "BroadcastHashJoin" in text


def run_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["accumulated_monthly_spend", "rentals_one_country"])
def test_a_filtered_side_is_broadcast_and_lines_are_not_sorted(spark, name):
    text = run_plan(QUERIES[name](spark, BASE))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_two_unfiltered_facts_are_merged(planned):
    assert "SortMergeJoin" in planned("customer_avg_order")


def test_nested_queries_run_no_job_while_planned(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    QUERIES["score_nested"](spark, BASE)
    jobs = tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []


def test_udf_example_is_the_only_python(spark, plan):
    counted = spark.createDataFrame([("x", 200)], "store_location STRING, count BIGINT")
    assert "EvalPython" in plan(retail.with_good_store_udf(counted))
    assert "EvalPython" not in plan(retail.with_good_store(counted))
