import glob
import os
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import final_plan, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.contracts import CONTRACTS
from tierstone.functions import clock
from tierstone.plans import gold, quality, refresh, reports, silver
from tierstone.sinks.csv import export_csv, read_export
from tierstone.sinks.store import LayerStore, create_statement

AS_OF = datetime(2024, 1, 31)


@pytest.fixture
def store(spark, tmp_path, request):
    prefix = "t_" + "".join(c for c in request.node.name if c.isalnum()).lower() + "_"
    store = LayerStore(spark, str(tmp_path / "lake"), prefix)
    yield store
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {store.namespace(layer)} CASCADE")


def test_all_thirteen_tables_are_created_twice_without_harm(spark, store):
    store.create()
    store.create()
    listed = {f"{r['layer']}.{r['table_name']}" for r in store.listing().collect()}
    assert listed == set(CONTRACTS) and len(listed) == 13
    for name, contract in CONTRACTS.items():
        schema = spark.table(store.table(name)).schema
        assert [(f.name, f.dataType) for f in schema][: len(contract.fields)] == list(contract.fields)
        assert store.read(name).count() == 0


def test_layout_shows_types_partitioning_and_comment(store):
    store.create("bronze.purchases")
    shown = {r["col_name"]: r["data_type"] for r in store.layout("bronze.purchases").collect()}
    assert shown["purchase_price"] == "decimal(12,2)"
    assert shown["# Partition Information"] == ""
    assert shown["part_created_at"] == "date"
    assert shown["Comment"] == CONTRACTS["bronze.purchases"].comment


def test_day_partitioning_needs_a_derived_column():
    statement = create_statement(CONTRACTS["bronze.users"], "x.users")
    assert "PARTITIONED BY (`part_created_at`)" in statement and "`part_created_at` DATE" in statement
    assert "PARTITIONED" not in create_statement(CONTRACTS["gold.top_selling_items"], "x.t")


def test_overwrite_replaces_everything(store, shop):
    store.create("bronze.pageviews")
    first = shop.pageviews((1, "/a", "x", datetime(2024, 1, 1)), (2, "/b", "x", datetime(2024, 1, 2)))
    second = shop.pageviews((3, "/c", "y", datetime(2024, 1, 2)))
    assert store.overwrite(first, "bronze.pageviews") == 2
    assert store.overwrite(second, "bronze.pageviews") == 1
    assert rows_of(store.read("bronze.pageviews")) == rows_of(second)
    assert store.overwrite(second.limit(0), "bronze.pageviews") == 0
    assert store.read("bronze.pageviews").isEmpty()


def test_empty_and_missing_category_survive_value_partitioning(store, shop):
    store.create("bronze.items")
    items = shop.items((1, "a", "", "1.00"), (2, "b", None, "1.00"), (3, "c", "x/y=z", "1.00"))
    store.overwrite(items, "bronze.items")
    assert rows_of(store.read("bronze.items")) == rows_of(items)


def test_days_outside_the_bounds_are_not_opened(store, shop):
    store.create("bronze.pageviews")
    days = [datetime(2024, 1, d, 12) for d in range(1, 11)]
    store.overwrite(shop.pageviews(*[(i, "/x", "c", d) for i, d in enumerate(days)]), "bronze.pageviews")
    since = F.lit("2024-01-09 12:00:00").cast("timestamp")
    late = store.read("bronze.pageviews", since=since)
    assert [r["user_id"] for r in late.orderBy("user_id").collect()] == [8, 9]
    assert "PartitionFilters: [isnotnull(part_received_at" in final_plan(late)
    assert "(part_received_at#" in final_plan(late).split("PartitionFilters:")[1]
    until = F.lit("2024-01-02 12:00:00").cast("timestamp")
    assert store.read("bronze.pageviews", until=until).count() == 2
    with pytest.raises(ValueError):
        store.create("gold.top_selling_items").read("gold.top_selling_items", since=since)


def test_pruning_follows_the_running_clock(store, shop):
    store.create("silver.purchases_enriched")
    now = datetime.now()
    sales = shop.purchases((1, 1, 1, 1, "1.00", now), (2, 1, 1, 1, "2.00", now - timedelta(days=9)))
    enriched = silver.purchases_enriched(sales, shop.users(), shop.items())
    store.overwrite(enriched, "silver.purchases_enriched")
    recent = store.read("silver.purchases_enriched", since=clock.hours_before(24))
    assert [r["total_revenue"] for r in gold.sales_performance_24h(recent).collect()] == [Decimal("1.00")]
    filters = final_plan(recent).split("PartitionFilters:")[1].split("PushedFilters")[0]
    # The clock is a constant by the time folders are listed.
    day = (now - timedelta(hours=24)).date().isoformat()
    assert f">= {day})" in filters


def test_a_heavy_day_is_written_by_several_tasks(spark, store, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="400KB")
    store.create("bronze.pageviews")
    n = F.col("id")
    heavy = spark.range(0, 40000, 1, 8).select(
        n.alias("user_id"),
        F.sha2(n.cast("string"), 256).alias("url"),
        F.lit("c").alias("channel"),
        F.when(n % 3 == 0, F.lit("2024-01-01")).otherwise(
            F.concat(F.lit("2024-02-"), F.lpad((n % 20 + 1).cast("string"), 2, "0"))
        ).cast("timestamp").alias("received_at"),
    )
    assert store.overwrite(heavy, "bronze.pageviews") == 40000
    counts = {
        r["day"]: r["files"]
        for r in spark.table(store.table("bronze.pageviews"))
        .groupBy(F.col("part_received_at").cast("string").alias("day"))
        .agg(F.count_distinct("_metadata.file_path").alias("files"))
        .collect()
    }
    assert counts["2024-01-01"] > 1
    # Without regrouping, 8 tasks would open a file in each of 21 folders.
    assert sum(counts.values()) < 8 * 21 / 2


def test_insert_values_read_back_drop(spark, store):
    """Create, insert two rows, read them back sorted, check where the files are."""
    store.create("bronze.users")
    target = f"{store.namespace('bronze')}.notes"
    spark.sql(f"CREATE TABLE {target} (id BIGINT, msg STRING) USING parquet")
    spark.sql(f"INSERT INTO {target} VALUES (1, 'hello'), (2, 'world')")
    assert [tuple(r) for r in spark.sql(f"SELECT * FROM {target} ORDER BY id").collect()] == [
        (1, "hello"), (2, "world")]
    files = reports.rows_per_file(spark.table(target)).collect()
    assert sum(r["record_count"] for r in files) == 2
    assert all(store.root in r["file_path"] for r in files)
    store.drop("bronze.users")
    assert not spark.catalog.tableExists(store.table("bronze.users"))


def segments(shop, n):
    users = silver.users(shop.users(*[(i, "A", str(i), f"u{i}@example.com") for i in range(n)]))
    views = silver.item_views(shop.pageviews((1, "/products/1", "x")))
    return gold.user_engagement_segments(users, views, AS_OF)


def test_single_file_export_is_one_part_with_header(spark, shop, tmp_path):
    df = segments(shop, 20).repartition(4)
    path = str(tmp_path / "csv")
    export_csv(df, path, single_file=True)
    parts = glob.glob(f"{path}/*.csv")
    assert len(parts) == 1 and glob.glob(f"{path}/_SUCCESS")
    with open(parts[0]) as part:
        assert part.readline().strip() == ",".join(CONTRACTS["gold.user_engagement_segments"].columns)
    schema = CONTRACTS["gold.user_engagement_segments"].schema
    assert rows_of(read_export(spark, path, schema)) == rows_of(df)


def test_export_stays_in_parts_and_loses_nothing(spark, shop, tmp_path):
    df = segments(shop, 40).repartition(4)
    path = str(tmp_path / "csv")
    export_csv(df, path)
    assert len(glob.glob(f"{path}/*.csv")) == 4
    schema = CONTRACTS["gold.user_engagement_segments"].schema
    assert rows_of(read_export(spark, path, schema)) == rows_of(df)


def test_full_refresh(spark, store, shop, tmp_path):
    click_schema = "user_id long, url string, channel string, received_at long"
    sources = refresh.Sources(
        shop.users((1, "A", "B", "a@example.com"), (2, "C", "D", None)),
        shop.items((10, "lamp", "gadgets", "-2.00"), (11, "rug", "doodads", "3.00")),
        shop.purchases((1, 1, 10, 2, "5.00", datetime(2024, 1, 30, 8)), (2, 7, 99, 1, "1.00", datetime(2024, 1, 3))),
        spark.createDataFrame(
            [(1, "/products/10", "social", 1706601600), (1, "/about", "social", 1706601600)], click_schema
        ),
    )
    stored = refresh.refresh(store, sources, str(tmp_path / "segments"), AS_OF)
    assert stored == {
        "bronze.users": 2, "bronze.items": 2, "bronze.purchases": 2, "bronze.pageviews": 2,
        "silver.users": 2, "silver.items": 2, "silver.purchases_enriched": 2,
        "silver.pageviews_by_items": 1, "gold.item_performance": 2, "gold.top_selling_items": 2,
        "gold.sales_performance_24h": 1, "gold.pageviews_by_channel": 1,
        "gold.user_engagement_segments": 1,
    }
    # Categories: source spelling in the facts, upper case in the item table.
    assert {r[0] for r in store.read("gold.top_selling_items").select("item_category").collect()} == {"gadgets", None}
    assert {r[0] for r in store.read("gold.item_performance").select("item_category").collect()} == {"GADGETS", "DOODADS"}
    hour = store.read("gold.sales_performance_24h").first()
    assert tuple(hour) == (8, Decimal("10.00"))
    exported = read_export(spark, str(tmp_path / "segments"), CONTRACTS["gold.user_engagement_segments"].schema)
    assert rows_of(exported) == rows_of(store.read("gold.user_engagement_segments"))
    # A second run gives the same tables.
    assert refresh.refresh(store, sources, str(tmp_path / "segments"), AS_OF) == stored


def test_table_files_are_parquet_with_declared_types(spark, store, shop):
    store.create("silver.items")
    store.overwrite(silver.items(shop.items((1, "a", "c", "-1.00"))), "silver.items")
    assert isinstance(store.read("silver.items").schema["price"].dataType, T.DecimalType)
    assert store.read("silver.items").first()["price"] == Decimal("0.00")


# --- upserts, layout of facts, backfills ---------------------------------------------------


def files_of(spark, store, name):
    folder = store.location(name).removeprefix("file:")
    return {os.path.relpath(f, folder): os.path.getmtime(f) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


def test_upsert_rewrites_touched_folders_only(spark, store):
    schema = CONTRACTS["bronze.items"].schema
    day = datetime(2024, 1, 1)
    row = lambda i, category, price, at=day: (i, f"n{i}", category, Decimal(price), 1, at, at)
    first = [row(1, "a", "1.00"), row(2, "b", "1.00"), row(3, "c", "1.00"), row(4, "it's", "1.00"), row(5, None, "1.00")]
    store.create("bronze.items").overwrite(spark.createDataFrame(first, schema), "bronze.items")
    before = files_of(spark, store, "bronze.items")
    later = datetime(2024, 1, 2)
    delivery = [row(2, "d", "2.00", later), row(3, "c", "9.00", datetime(2023, 1, 1)), row(None, "c", "3.00"),
                row(4, "c", "4.00", later), row(9, "e", "5.00")]
    assert store.upsert(spark.createDataFrame(delivery, schema), "bronze.items", ["id"], ["updated_at"]) == 7
    got = {(r["id"], r["category"], str(r["price"])) for r in store.read("bronze.items").collect()}
    assert got == {(1, "a", "1.00"), (2, "d", "2.00"), (3, "c", "1.00"), (4, "c", "4.00"), (5, None, "1.00"),
                   (None, "c", "3.00"), (9, "e", "5.00")}
    after = files_of(spark, store, "bronze.items")
    untouched = [f for f in before if f.startswith(("part_category=a/", "part_category=__HIVE"))]
    assert len(untouched) == 2 and all(after.get(f) == before[f] for f in untouched)
    assert not any(f.startswith("part_category=b/") for f in after)


def test_objects_that_span_all_days_give_few_files_per_day(spark, store, shop):
    """32 scattered tasks, 10 days: regrouped, not 320 files; a heavy day is still split."""
    views = spark.range(20000).select(
        F.col("id").alias("user_id"), F.lit("/p/1").alias("url"), F.lit("x").alias("channel"),
        F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, CAST(id % 10 AS INT))").alias("received_at"),
    ).repartition(32)
    store.create("bronze.pageviews").overwrite(views, "bronze.pageviews")
    assert len(files_of(spark, store, "bronze.pageviews")) <= 12


def test_gates_stop_a_refresh_before_silver(spark, store, shop, tmp_path):
    sources = refresh.Sources(
        shop.users((1, "A", "B", "a@example.com")),
        shop.items((10, None, "gadgets", "2.00")),
        shop.purchases((1, 1, 10, 2, "5.00", datetime(2024, 1, 30, 8))),
        shop.pageviews((1, "/products/10", "x")),
    )
    with pytest.raises(quality.GateFailed, match="bronze.items: name_present"):
        refresh.refresh(store, sources, str(tmp_path / "csv"), enforce=True)
    assert store.stored_rows("bronze.items") == 1 and store.stored_rows("silver.items") == 0


def test_a_backfill_opens_folders_between_both_bounds(spark, store, shop):
    store.create("silver.purchases_enriched")
    end = F.lit("2024-01-10 00:00:00").cast("timestamp")
    rows = store.read("silver.purchases_enriched", end - F.expr("INTERVAL 24 HOURS"), end)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "2024-01-09" in pruned.replace("19731", "2024-01-09") and "<=" in pruned and ">=" in pruned


def test_staged_folders_are_published_without_another_shuffle(spark, store, monkeypatch):
    store.create("bronze.items")
    row = lambda n, kind: (n, f"i{n}", kind, Decimal("1.00"), 1, AS_OF, AS_OF)
    schema = CONTRACTS["bronze.items"].schema
    store.overwrite(spark.createDataFrame([row(1, "a"), row(2, "b"), row(3, "c")], schema), "bronze.items")
    plans, publish = [], LayerStore._replace_folders

    def watched(self, rows, table):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        publish(self, rows, table)

    monkeypatch.setattr(LayerStore, "_replace_folders", watched)
    store.upsert(spark.createDataFrame([row(1, "b"), row(4, "d")], schema), "bronze.items", ["id"], ["updated_at"])
    assert len(plans) == 1 and "Exchange" not in plans[0]
    found = {(r["id"], r["category"]) for r in store.read("bronze.items").collect()}
    assert found == {(1, "b"), (2, "b"), (3, "c"), (4, "d")}
