"""What the physical plans look like when no input is small enough to broadcast."""

import glob
import re

import pytest
from conftest import TINY, final_plan

from tierstone.plans import bronze, reports, silver
from tierstone.registry.queries import QUERIES, _views
from tierstone.sources import shop_tables
from tierstone.streaming import clicks


@pytest.fixture
def no_broadcast(settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__autoBroadcastJoinThreshold="-1")


def scans(plan):
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_any_query(spark, name):
    plan = QUERIES[name](spark, TINY)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython",
                     "MapInPandas", "Window "):
        assert operator not in plan, operator


def test_item_performance_has_one_join_and_shuffles_sums(spark, no_broadcast):
    plan = final_plan(QUERIES["item_performance"](spark, TINY))
    assert plan.count("SortMergeJoin") == 1
    # Exactly two shuffles: the items, and the partial sums of both facts together.
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.index("Exchange hashpartitioning(item_id#") and "partial_sum" in plan
    assert not any("received_at" in s or "user_id" in s for s in scans(plan))


def test_top_sellers_label_sums_not_purchases(spark, no_broadcast):
    plan = final_plan(QUERIES["top_selling_items"](spark, TINY))
    assert "TakeOrderedAndProject" in plan
    assert plan.count("Exchange hashpartitioning") == 2
    below_join = plan[plan.index("SortMergeJoin"):]
    assert "partial_sum" in below_join


def test_engagement_reduces_views_before_any_shuffle(spark, no_broadcast):
    plan = final_plan(QUERIES["user_engagement_segments"](spark, TINY))
    assert plan.count("SortMergeJoin") == 1
    first_view_shuffle = plan.index("Exchange hashpartitioning(user_id", plan.index("merge_count"))
    assert "partial_count(page" in plan[first_view_shuffle:]
    # Unreachable users are dropped at the scan side of the join.
    users = plan[: plan.index("c_custkey", plan.index("FileScan"))]
    assert "RLIKE" in users


def test_24h_filter_reaches_the_scan(spark):
    plan = final_plan(QUERIES["sales_performance_24h"](spark, TINY))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", plan).group(1)
    assert "EqualTo(event_type,purchase)" in pushed and "GreaterThanOrEqual(ts,2024-0" in pushed
    assert scans(plan) == ["struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>"]


def test_time_range_and_channel_filters_reach_the_scan(spark):
    ranged = final_plan(QUERIES["time_range_filter"](spark, TINY))
    assert "GreaterThanOrEqual(ts," in ranged and "LessThan(ts," in ranged
    assert "EqualTo(event_type,view)" in final_plan(QUERIES["channel_filter"](spark, TINY))


def test_counting_rows_reads_no_columns(spark):
    plan = final_plan(QUERIES["layer_row_counts"](spark, TINY))
    assert scans(plan).count("struct<>") == 2


def test_url_is_parsed_once_per_row(spark):
    plan = final_plan(_views(spark, TINY).select("user_id", "item_id"))
    # The operator line names the expression once; filters read the column.
    assert plan.count("regexp_extract") == 1


def test_sales_tables_read_no_users(spark):
    for name in ("item_performance", "top_selling_items", "sales_performance_24h"):
        assert "c_mktsegment" not in final_plan(QUERIES[name](spark, TINY))


def test_salted_lookups_join_twice_and_find_hot_keys_before(spark, settings, tmp_path):
    """Hot keys come from the source facts: no join is planned a second time for them."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    facts = bronze.purchases(shop_tables.purchases(spark, TINY))
    users, items = bronze.users(shop_tables.users(spark, TINY)), bronze.items(shop_tables.items(spark, TINY))
    plan = final_plan(silver.purchases_enriched(facts, users, items, salts=4))
    assert plan.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan


def test_lookups_shuffle_no_derived_columns(spark, no_broadcast):
    facts = bronze.purchases(shop_tables.purchases(spark, TINY))
    users, items = bronze.users(shop_tables.users(spark, TINY)), bronze.items(shop_tables.items(spark, TINY))
    plan = final_plan(silver.purchases_enriched(facts, users, items))
    below_join = plan[plan.index("SortMergeJoin"):].split("Initial Plan")[0]
    assert not any(name in below_join for name in ("total_price", "purchase_date", "purchase_hour"))


def test_a_regrouped_table_is_written_by_several_tasks(spark):
    """Although all of it would fit one partition of the advisory size."""
    rows = spark.range(2_000_000).selectExpr("id % 31 AS day", "xxhash64(id) AS x").hint("rebalance", "day")
    tasks = rows.selectExpr("spark_partition_id() AS p", "x").groupBy("p").agg({"x": "max"})
    assert len(tasks.collect()) > 1


def test_channel_counts_read_no_json(spark):
    counted = reports.channel_counts(bronze.pageviews(shop_tables.clicks(spark, TINY, whole=False)))
    plan = final_plan(counted)
    assert "get_json_object" not in plan and "props" not in plan.split("ReadSchema")[1].splitlines()[0]


def test_a_stream_batch_fills_few_files_a_day(spark, tmp_path):
    log = shop_tables.click_log(spark, TINY).repartition(24)
    log.write.json(str(tmp_path / "json"))
    stream = clicks.click_stream(spark, str(tmp_path / "json"))
    clicks.ingest_available(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), files_per_day=2)
    days = glob.glob(str(tmp_path / "out" / "part_received_at=*"))
    assert len(days) > 20 and all(len(glob.glob(f"{d}/*.parquet")) <= 2 for d in days)
    assert clicks.read_ingested(spark, str(tmp_path / "out")).count() == log.count()
