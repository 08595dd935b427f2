from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import T0, rows_of
from pyspark.sql import functions as F

from tierstone.contracts import CONTRACTS
from tierstone.plans import bronze, gold, reports, silver

AS_OF = datetime(2024, 1, 31)


# --- bronze


def test_bronze_casts_to_the_contract_and_orders_columns(spark):
    raw = spark.createDataFrame(
        [("7", "8", "9", 3, "1.239", "2024-01-01 00:00:00", None, "extra")],
        "user_id string, id string, item_id string, quantity long, purchase_price string,"
        " created_at string, updated_at string, note string",
    )
    landed = bronze.purchases(raw)
    assert landed.schema == CONTRACTS["bronze.purchases"].schema
    assert landed.first()[:5] == (8, 7, 9, 3, Decimal("1.24"))


def test_bronze_turns_unusable_values_into_null(spark):
    raw = spark.createDataFrame(
        [("x", "1.2.3", None)], "user_id string, received_at string, url string"
    ).withColumn("channel", F.lit("c"))
    assert bronze.pageviews(raw).first() == (None, None, "c", None)


def test_bronze_names_missing_columns(spark):
    with pytest.raises(ValueError, match="first_name, last_name"):
        bronze.users(spark.range(1).select("id", *(F.lit("").alias(c) for c in
                     ("email", "created_at", "updated_at"))))


def test_epoch_seconds_become_timestamps(spark):
    raw = spark.createDataFrame(
        [(1, "/about", "social", 1700000000)],
        "user_id long, url string, channel string, received_at long",
    )
    text = bronze.pageviews(raw).select(F.date_format("received_at", "yyyy-MM-dd HH:mm:ss"))
    assert text.first()[0] == "2023-11-14 22:13:20"


# --- silver


def test_silver_schemas_match_the_contracts(shop):
    users, items = shop.users((1, "A", "B", None)), shop.items((1, "n", "c", "1.00"))
    sales, views = shop.purchases((1, 1, 1, 1, "1.00")), shop.pageviews((1, "/products/1", "x"))
    built = {
        "silver.users": silver.users(users),
        "silver.items": silver.items(items),
        "silver.purchases_enriched": silver.purchases_enriched(sales, users, items),
        "silver.pageviews_by_items": silver.pageviews_by_items(views, items),
    }
    for name, df in built.items():
        assert [(f.name, f.dataType) for f in df.schema] == list(CONTRACTS[name].fields), name


def test_enrichment_keeps_orphans_and_source_spelling(shop):
    users = shop.users((1, "A", "B", "a@example.com"))
    items = shop.items((10, "lamp", "gadgets", "-4.00"))
    sales = shop.purchases((100, 1, 10, 2, "3.00"), (101, 9, 999999, 1, "5.00"), (102, None, None, 1, "6.00"))
    found = {r["id"]: r for r in silver.purchases_enriched(sales, users, items).collect()}
    assert len(found) == 3
    assert found[100]["item_category"] == "gadgets"
    # The purchase's own unit price counts, not the item's.
    assert found[100]["total_price"] == Decimal("6.00")
    assert (found[100]["purchase_date"], found[100]["purchase_hour"]) == (date(2024, 1, 30), 12)
    assert found[101]["user_email"] is None and found[101]["item_name"] is None
    assert found[102]["total_price"] == Decimal("6.00")


def test_item_views_drop_urls_without_number_and_keep_odd_pages(shop):
    views = shop.pageviews((1, "/about", "x"), (1, "/a/b/7", "x"), (1, "/cart/3", "x"),
                           (1, "/products/99999999999999999999", "x"), (None, "/products/5", None))
    assert rows_of(silver.item_views(views).select("item_id", "page")) == [
        (3, "cart"), (5, "products"), (7, ""),
    ]


# --- gold


@pytest.fixture
def performance(shop):
    items = shop.items(
        (1, "sold", "c", "1.00"), (2, "viewed only", "c", "1.00"),
        (3, "untouched", "c", "1.00"), (4, "sold unseen", "c", "1.00"),
    )
    sales = shop.purchases(
        (1, 1, 1, 2, "1.50"), (2, 1, 1, 1, "1.00"), (3, 1, 4, 1, "9.00"), (4, 1, 999999, 1, "7.00"),
        (5, 1, None, 1, "7.00"),
    )
    views = shop.pageviews(
        *[(1, "/products/1", "x")] * 4, *[(1, "/products/2", "x")] * 5,
        (1, "/cart/1", "x"), (1, "/a/b/1", "x"), (1, "/products/999999", "x"),
    )
    df = gold.item_performance(silver.items(items), silver.priced(sales), silver.item_views(views))
    return df


def test_item_performance_values(performance):
    assert [(f.name, f.dataType) for f in performance.schema] == list(
        CONTRACTS["gold.item_performance"].fields
    )
    assert {r[0]: tuple(r[3:]) for r in performance.collect()} == {
        1: (3, 2, Decimal("4.00"), 4, 0.5),
        2: (0, 0, Decimal("0.00"), 5, None),
        3: (0, 0, Decimal("0.00"), 0, 0.0),
        4: (1, 1, Decimal("9.00"), 0, 0.0),
    }


def test_item_performance_counts_only_purchases_with_a_number(shop):
    items = silver.items(shop.items((1, "n", "c", "1.00")))
    sales = silver.priced(shop.purchases((None, 1, 1, 1, "1.00")))
    views = silver.item_views(shop.pageviews((1, "/products/1", "x")))
    row = gold.item_performance(items, sales, views).first()
    assert (row["items_sold"], row["orders"], row["conversion_rate"]) == (1, 0, 0.0)


def test_item_performance_is_the_same_from_full_silver(shop, performance):
    items = shop.items((1, "a", "c", "1.00"), (2, "b", "d", "1.00"))
    users = shop.users((1, "A", "B", None))
    sales = shop.purchases((1, 1, 1, 2, "1.50"), (2, 5, 2, 1, "1.00"))
    views = shop.pageviews((1, "/products/1", "x"), (1, "/products/2", "x"))
    narrow = gold.item_performance(silver.items(items), silver.priced(sales), silver.item_views(views))
    full = gold.item_performance(
        silver.items(items),
        silver.purchases_enriched(sales, users, items),
        silver.pageviews_by_items(views, items),
    )
    assert rows_of(narrow) == rows_of(full)


def test_converters_put_never_sold_last_and_idle_traffic_first(performance):
    assert [r["item_name"] for r in reports.best_converters(performance).collect()] == [
        "sold", "viewed only"]
    assert [r["item_name"] for r in reports.traffic_without_sales(performance).collect()] == [
        "viewed only", "sold"]


def test_top_selling_includes_orphans_and_breaks_ties_by_item(shop):
    items = shop.items((2, "two", "c", "1.00"), (1, "one", "c", "1.00"))
    users = shop.users()
    sales = shop.purchases((1, 1, 2, 1, "5.00"), (2, 1, 1, 1, "5.00"), (3, 1, 999999, 1, "8.00"))
    from_full = gold.top_selling_items(silver.purchases_enriched(sales, users, items), k=2)
    from_narrow = gold.top_selling_items(silver.priced(sales), items, k=2)
    expected = [(999999, None, None, Decimal("8.00")), (1, "one", "c", Decimal("5.00"))]
    assert [tuple(r) for r in from_full.collect()] == expected
    assert [tuple(r) for r in from_narrow.collect()] == expected


def test_last_24_hours_has_both_bounds_for_a_past_moment(shop):
    sales = silver.priced(
        shop.purchases(
            (1, 1, 1, 1, "1.00", datetime(2024, 1, 30, 0, 0, 0)),
            (2, 1, 1, 1, "2.00", datetime(2024, 1, 29, 23, 59, 59)),
            (3, 1, 1, 1, "4.00", datetime(2024, 1, 31, 0, 0, 0)),
            (4, 1, 1, 1, "8.00", datetime(2024, 1, 31, 0, 0, 1)),
            (5, 1, 1, 1, "16.00", datetime(2024, 1, 30, 13, 30)),
        )
    )
    assert [tuple(r) for r in gold.sales_performance_24h(sales, AS_OF).collect()] == [
        (0, Decimal("5.00")), (13, Decimal("16.00"))]
    # The exact variant keeps the two midnights apart.
    assert len(gold.hourly_revenue(sales, 24, AS_OF).collect()) == 3


def test_last_24_hours_defaults_to_now(shop):
    now = datetime.now()
    sales = silver.priced(
        shop.purchases((1, 1, 1, 1, "1.00", now - timedelta(hours=2)),
                       (2, 1, 1, 1, "2.00", now - timedelta(hours=26)))
    )
    assert [r["total_revenue"] for r in gold.sales_performance_24h(sales).collect()] == [Decimal("1.00")]


def test_channels_count_item_views_of_any_page(shop):
    views = silver.item_views(
        shop.pageviews((1, "/cart/1", "a"), (1, "/products/1", "a"), (1, "/about", "b"), (1, "/x/y/2", "b"))
    )
    assert [tuple(r) for r in gold.pageviews_by_channel(views).collect()] == [("a", 2), ("b", 1)]


def test_segments(shop):
    users = silver.users(
        shop.users(
            (1, "High", "User", "h@example.com"), (2, "No", "Views", "n@example.com"),
            (3, "No", "Mail", None), (4, "Bad", "Mail", "bad-4"), (5, None, "Medium", "m@example.com"),
        )
    )
    views = silver.item_views(
        shop.pageviews(
            *[(1, "/products/1", "x", datetime(2024, 1, 29, h)) for h in range(7)],
            (1, "/a/b/9", "x", datetime(2024, 1, 28)),
            *[(3, "/products/1", "x")] * 9,
            *[(5, "/cart/2", "x", datetime(2024, 1, 24)) for _ in range(3)],
            (1, "/products/1", "x", datetime(2024, 2, 5)),
            (77, "/products/1", "x"),
        )
    )
    df = gold.user_engagement_segments(users, views, AS_OF)
    assert [(f.name, f.dataType) for f in df.schema] == list(
        CONTRACTS["gold.user_engagement_segments"].fields
    )
    assert rows_of(df) == [
        (1, "h@example.com", "High User", 8, 2, date(2024, 1, 29), 2, "high_engagement"),
        (2, "n@example.com", "No Views", 0, 0, None, None, "low_engagement"),
        (5, "m@example.com", "Medium", 3, 1, date(2024, 1, 24), 7, "medium_engagement"),
    ]
    assert [tuple(r) for r in reports.segment_sizes(df).collect()] == [
        ("high_engagement", 1), ("low_engagement", 1), ("medium_engagement", 1)]


def test_segments_without_reference_time_count_all_views(shop):
    users = silver.users(shop.users((1, "A", "B", "a@example.com")))
    future = datetime.now() + timedelta(days=2)
    views = silver.item_views(shop.pageviews((1, "/products/1", "x", future)))
    row = gold.user_engagement_segments(users, views).first()
    assert row["total_pageviews"] == 1 and row["days_since_last_active"] < 0


def test_third_axis_adds_spending(shop):
    users = silver.users(shop.users((1, "A", "B", "a@example.com"), (2, "C", "D", "c@example.com")))
    sales = silver.priced(shop.purchases((1, 1, 1, 2, "60.00"), (2, 1, 1, 1, "30.00")))
    df = gold.rfm_segments(users, silver.item_views(shop.pageviews()), sales, 150, AS_OF)
    assert rows_of(df.select("user_id", "total_spent", "value_segment")) == [
        (1, Decimal("150.00"), "high_value"), (2, Decimal("0.00"), "low_value")]


# --- reports


def test_email_validity_has_up_to_three_groups(shop):
    users = silver.users(shop.users((1, "", "", None), (2, "", "", "x"), (3, "", "", "a@b.com")))
    assert rows_of(reports.email_validity(users)) == [(False, 1), (True, 1), (None, 1)]


def test_reports_on_bronze_views(shop):
    views = shop.pageviews((1, "/about", "a"), (1, "/products/1", "b", datetime(2024, 2, 2)))
    assert rows_of(reports.channel_counts(views)) == [("a", 1), ("b", 1)]
    assert reports.on_channel(views, "a").count() == 1
    assert reports.received_since(views, datetime(2024, 2, 1)).count() == 1
    assert reports.received_since(views, T0, datetime(2024, 2, 1)).count() == 1


def test_category_reports(performance):
    assert [tuple(r) for r in reports.revenue_by_category(performance).collect()] == [
        ("C", 3, Decimal("13.00"), 9)]
    averaged = reports.average_by(performance, "item_category", "revenue", "cnt", "avg_revenue")
    assert [tuple(r) for r in averaged.collect()] == [("C", 4, 3.25)]


def test_row_counts_and_parity(spark):
    tables = {"a": spark.range(3), "b": spark.range(0)}
    assert rows_of(reports.row_counts(tables)) == [("a", 3), ("b", 0)]
    other = {"a": spark.range(2), "b": spark.range(0)}
    assert rows_of(reports.count_parity(tables, other)) == [("a", 3, 2, False), ("b", 0, 0, True)]
    missing = reports.count_parity(tables, {"a": spark.range(3)})
    assert rows_of(missing) == [("a", 3, 3, True), ("b", 0, None, False)]


def test_run_sql_binds_views_and_gives_everything(spark):
    df = reports.run_sql(spark, "SELECT id FROM numbers ORDER BY id DESC", numbers=spark.range(10))
    assert [r["id"] for r in df.collect()] == list(range(9, -1, -1))
    assert reports.run_sql(spark, "SELECT * FROM numbers", bind="again", numbers=spark.range(500)).count() == 500
    assert reports.run_sql(spark, "SELECT * FROM again WHERE id >= 150").count() == 350
    assert reports.shown(reports.run_sql(spark, "SELECT * FROM again")).count() == 100


def test_as_record_turns_first_row(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b")
    assert [tuple(r) for r in reports.as_record(df).collect()] == [("a", "1"), ("b", None)]
