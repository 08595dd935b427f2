"""Validity intervals, mergeable activity and content parity against plain versions."""

import glob
import os
from datetime import date, datetime

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tierstone.contracts import CONTRACTS
from tierstone.plans import activity, gold, parity, silver
from tierstone.plans.history import LoadHistory
from tierstone.plans.validity import PIECE_ROWS, IntervalHistory

SCHEMA = "id long, stamp long, v string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


# --- validity intervals


def test_intervals_equal_whole_copies_on_four_loads(spark, tmp_path):
    first = frame(spark, (1, 5, "a"), (2, 5, "b"), (2, 5, "b"), (None, 5, "n"), (3, None, None), (4, 1, ""))
    changed = frame(spark, (1, 6, "a2"), (4, 0, "stale"), (None, 7, "n2"), (9, 1, "new"))
    fewer = frame(spark, (1, 5, "a"), (2, 5, "b"), (None, 5, "n"), (None, 5, "n"))
    copies = LoadHistory(spark, str(tmp_path / "copies"))
    ours = IntervalHistory(spark, str(tmp_path / "ours"), first.schema)
    for loads in (copies, ours):
        loads.add(first.where("id IS NULL OR id <> 2"), 1, datetime(2024, 1, 1))
        loads.add_increment(changed, ["id"], ["stamp"], 2, datetime(2024, 1, 2))
        loads.add(fewer, 3, datetime(2024, 1, 3))
        loads.add(first, 4, datetime(2024, 1, 4))
    for day in (1, 2, 3, 4):
        for moment in (datetime(2024, 1, day), datetime(2024, 1, day, 23)):
            assert rows_of(ours.as_of(moment)) == rows_of(copies.as_of(moment))
        assert rows_of(ours.version(day)) == rows_of(copies.version(day))
    assert rows_of(ours.log()) == rows_of(copies.log())
    with pytest.raises(LookupError):
        ours.as_of(datetime(2023, 12, 31))
    with pytest.raises(LookupError):
        ours.version(5)


def test_a_content_that_goes_and_comes_back_has_two_intervals(spark, tmp_path):
    loads = IntervalHistory(spark, str(tmp_path / "h"), frame(spark, (1, 1, "a")).schema)
    for n, rows in enumerate(([(1, 1, "a"), (2, 1, "b")], [(2, 1, "b")], [(1, 1, "a"), (2, 1, "b")]), start=1):
        loads.add(frame(spark, *rows), n, datetime(2024, 1, n))
    one, two, three = (datetime(2024, 1, n) for n in (1, 2, 3))
    assert rows_of(loads.intervals()) == [
        (1, 1, "a", one, two, 1), (1, 1, "a", three, None, 1), (2, 1, "b", one, None, 1)]


def test_a_load_stores_its_changes_only(spark, tmp_path):
    rows = spark.range(5000).select("id", F.col("id").alias("stamp"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    loads = IntervalHistory(spark, str(tmp_path / "h"), rows.schema)
    loads.add(rows, 1, datetime(2024, 1, 1))
    loads.add(rows.withColumn("stamp", F.expr("stamp + int(id < 3)")), 2, datetime(2024, 1, 2))
    loads.add(rows.withColumn("stamp", F.expr("stamp + int(id < 3)")), 3, datetime(2024, 1, 3))
    stored = [spark.read.parquet(f"{tmp_path}/h/load_id={n}").count() for n in (1, 2, 3)]
    assert stored == [5000, 6, 0]
    # A past state opens the files of its own loads only.
    assert not [f for f in loads.as_of(datetime(2024, 1, 1, 1)).inputFiles() if "load_id=1" not in f]


def test_many_equal_rows_are_kept_in_pieces(spark, tmp_path):
    many = 2 * PIECE_ROWS + 7
    rows = spark.range(many).select(F.lit(1).cast("long").alias("id"), F.lit(1).cast("long").alias("stamp"), F.lit("x").alias("v"))
    loads = IntervalHistory(spark, str(tmp_path / "h"), rows.schema)
    assert loads.add(rows, 1, datetime(2024, 1, 1)) == many
    assert loads.add(rows.limit(5), 2, datetime(2024, 1, 2)) == 5
    assert loads.as_of(datetime(2024, 1, 1)).count() == many
    assert loads.as_of(datetime(2024, 1, 2)).count() == 5
    assert max(r["n"] for r in loads.intervals().collect()) == PIECE_ROWS


def test_a_load_that_died_is_repeated_and_order_is_kept(spark, tmp_path):
    loads = IntervalHistory(spark, str(tmp_path / "h"), frame(spark, (1, 1, "a")).schema)
    assert loads.add(frame(spark), 1, datetime(2024, 1, 1)) == 0
    loads.add(frame(spark, (1, 1, "a")), 2, datetime(2024, 1, 2))
    # Files of a load without its log row.
    spark.read.parquet(f"{tmp_path}/h/load_id=2").write.parquet(f"{tmp_path}/h/load_id=3")
    assert rows_of(loads.as_of(datetime(2024, 6, 1))) == [(1, 1, "a")]
    loads.add(frame(spark, (2, 1, "b")), 3, datetime(2024, 1, 3))
    assert rows_of(loads.as_of(datetime(2024, 6, 1))) == [(2, 1, "b")]
    assert loads.as_of(datetime(2024, 1, 1)).count() == 0
    with pytest.raises(ValueError, match="already complete"):
        loads.add(frame(spark), 3, datetime(2024, 1, 4))
    with pytest.raises(ValueError, match="older"):
        loads.add(frame(spark), 4, datetime(2024, 1, 2))
    assert os.path.isdir(f"{tmp_path}/h/_log") and not glob.glob(f"{tmp_path}/h/load_id=4")


def test_column_names_of_the_store_may_be_the_tables_own(spark, tmp_path):
    rows = spark.sql("SELECT 1L AS n, 2L AS piece, 'r' AS row, 3L AS was, 4L AS change_, timestamp'2020-01-01' AS ended_at")
    loads = IntervalHistory(spark, str(tmp_path / "h"), rows.schema)
    loads.add(rows, 1, datetime(2024, 1, 1))
    loads.add(rows.withColumn("n", F.lit(9).cast("long")), 2, datetime(2024, 1, 2))
    assert rows_of(loads.as_of(datetime(2024, 1, 1))) == rows_of(rows)
    assert [r["n"] for r in loads.as_of(datetime(2024, 1, 2)).collect()] == [9]


# --- activity


def test_merged_halves_equal_distinct_days(spark, shop):
    moments = [datetime(2023, 12, 31, 23, 59), datetime(2024, 1, 1), datetime(2024, 1, 31, 5), datetime(2024, 2, 29)]
    seen = [(u, f"/products/{i}", "c", m) for u in (1, 2, None) for i in (1, 2) for m in moments[: 4 - (u == 2)]]
    views = silver.item_views(shop.pageviews(*seen, (3, "/about", "c", moments[0])))
    whole = rows_of(gold.visits(views))
    for half in ("user_id % 2 = 0", "item_id = 1", "received_at < timestamp'2024-01-31'", "true"):
        one, other = activity.states(views.where(half)), activity.states(views.where(f"NOT coalesce({half}, false)"))
        assert rows_of(activity.visits_of(activity.merged(one, other))) == whole
    assert whole[0] == (1, 8, 4, date(2024, 2, 29))
    assert rows_of(activity.visits_of(activity.states(views.where("false")))) == []


def test_activity_plan_expands_nothing(spark, shop):
    views = silver.item_views(shop.pageviews((1, "/products/1", "c")))
    plan = activity.visits_of(activity.states(views))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


# --- content parity


@pytest.mark.parametrize("fault, days", [
    ("SELECT * FROM t", set()),
    ("SELECT id, stamp, CASE WHEN id = 7 THEN 'x' ELSE v END AS v FROM t", {1}),
    ("SELECT * FROM t UNION ALL SELECT * FROM t WHERE id = 5", {2}),
    ("SELECT * FROM t WHERE id <> 3", {0}),
    ("SELECT id, v AS stamp, stamp AS v FROM t", {0, 1, 2}),
    ("SELECT id, CASE WHEN id = 4 THEN NULL ELSE stamp END AS stamp, CASE WHEN id = 4 THEN stamp ELSE v END AS v FROM t", {1}),
])
def test_parity_finds_changed_doubled_and_lost_rows(spark, fault, days):
    rows = spark.range(30).selectExpr("id", "string(id) AS stamp", "CASE WHEN id <> 4 THEN concat('v', id) END AS v")
    spoilt = spark.sql(fault.replace("FROM t", "FROM {t}"), t=rows)
    found = parity.content_parity("t", rows, spoilt.repartition(5), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")))
    assert {r["day"].day - 1 for r in found.where("NOT agrees").collect()} == days
    assert found.count() == 3


def test_parity_lists_a_day_that_one_side_lacks(spark):
    rows = spark.range(4).selectExpr("id", "date_add(date'2024-01-01', int(id % 2)) AS d")
    found = parity.content_parity("t", rows, rows.where("id % 2 = 0"), F.col("d"))
    assert rows_of(found) == [("t", date(2024, 1, 1), 2, 2, True), ("t", date(2024, 1, 2), 2, 0, False)]
    assert parity.content_parity("t", rows.limit(0), rows.limit(0)).count() == 0


def test_contracts_can_be_hashed(spark):
    for contract in CONTRACTS.values():
        assert parity.fingerprints(spark.createDataFrame([], contract.schema)).count() == 0
