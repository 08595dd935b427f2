"""Every table, report and round trip as a query over one folder of test tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import datetime
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.contracts import CONTRACTS, PRICE
from tierstone.functions import shop
from tierstone.operators.latest import upsert
from tierstone.plans import activity, bronze, gold, history, incremental, parity, quality, refresh, reports, silver
from tierstone.plans.validity import IntervalHistory
from tierstone.scratch import listing_of, new_folder
from tierstone.session import apply_runtime_settings
from tierstone.sinks.csv import export_csv, read_export
from tierstone.sinks.publish import AuditedTable
from tierstone.sinks.store import LayerStore
from tierstone.sources import ndjson, shop_tables
from tierstone.sources.objects import ClickIngest
from tierstone.streaming import clicks

AS_OF = datetime(2024, 1, 31)
SEGMENTS = "gold.user_engagement_segments"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name, with the runtime settings applied."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(apply_runtime_settings(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


# --- layers, lazily composed ------------------------------------------------------------


@query
def bronze_users(spark, sf_dir):
    return bronze.users(shop_tables.users(spark, sf_dir))


@query
def bronze_items(spark, sf_dir):
    return bronze.items(shop_tables.items(spark, sf_dir))


@query
def bronze_purchases(spark, sf_dir):
    return bronze.purchases(shop_tables.purchases(spark, sf_dir))


@query
def bronze_pageviews(spark, sf_dir):
    return bronze.pageviews(shop_tables.clicks(spark, sf_dir))


def _view_facts(spark, sf_dir):
    """Page views for readers of neither user nor URL."""
    return bronze.pageviews(shop_tables.clicks(spark, sf_dir, whole=False))


def bulk_purchases(spark, sf_dir, buyers=True):
    return bronze.purchases(shop_tables.bulk_purchases(spark, sf_dir, buyers))


@query
def silver_users(spark, sf_dir):
    return silver.users(bronze_users(spark, sf_dir))


@query
def silver_items(spark, sf_dir):
    return silver.items(bronze_items(spark, sf_dir))


@query
def purchases_enriched(spark, sf_dir):
    return silver.purchases_enriched(
        bronze_purchases(spark, sf_dir), bronze_users(spark, sf_dir), bronze_items(spark, sf_dir)
    )


@query
def purchases_enriched_salted(spark, sf_dir):
    """The same table with hot users and items spread before the joins."""
    return silver.purchases_enriched(
        bronze_purchases(spark, sf_dir), bronze_users(spark, sf_dir),
        bronze_items(spark, sf_dir), salts=8,
    )


@query
def purchases_enriched_bulk(spark, sf_dir):
    return silver.purchases_enriched(
        bulk_purchases(spark, sf_dir), bronze_users(spark, sf_dir), bronze_items(spark, sf_dir)
    )


@query
def pageviews_by_items(spark, sf_dir):
    return silver.pageviews_by_items(bronze_pageviews(spark, sf_dir), bronze_items(spark, sf_dir))


@query
def negative_clamp(spark, sf_dir):
    """The price rule on account balances, where negative amounts do occur."""
    balance = F.col("c_acctbal").cast("decimal(7,2)")
    return shop_tables.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), shop.floor_at_zero(balance, PRICE).alias("price")
    )


# --- gold --------------------------------------------------------------------------------


def _sales(spark, sf_dir):
    return silver.priced(bronze_purchases(spark, sf_dir))


def _bulk_sales(spark, sf_dir):
    return silver.priced(bulk_purchases(spark, sf_dir, buyers=False))


def _views(spark, sf_dir):
    return silver.item_views(bronze_pageviews(spark, sf_dir))


@query
def item_performance(spark, sf_dir):
    return gold.item_performance(
        silver_items(spark, sf_dir), _sales(spark, sf_dir), _views(spark, sf_dir)
    )


@query
def item_performance_bulk(spark, sf_dir):
    return gold.item_performance(
        silver_items(spark, sf_dir), _bulk_sales(spark, sf_dir), _views(spark, sf_dir)
    )


@query
def top_selling_items(spark, sf_dir):
    return gold.top_selling_items(_sales(spark, sf_dir), bronze_items(spark, sf_dir))


@query
def top_selling_items_bulk(spark, sf_dir):
    return gold.top_selling_items(_bulk_sales(spark, sf_dir), bronze_items(spark, sf_dir))


@query
def sales_performance_24h(spark, sf_dir):
    return gold.sales_performance_24h(_sales(spark, sf_dir), AS_OF)


@query
def pageviews_by_channel(spark, sf_dir):
    return gold.pageviews_by_channel(_views(spark, sf_dir))


@query
def user_engagement_segments(spark, sf_dir):
    return gold.user_engagement_segments(
        silver_users(spark, sf_dir), _views(spark, sf_dir), AS_OF
    )


# --- reports -------------------------------------------------------------------------------


@query
def segment_sizes(spark, sf_dir):
    return reports.segment_sizes(user_engagement_segments(spark, sf_dir))


@query
def top_earners(spark, sf_dir):
    return reports.top_earners(item_performance(spark, sf_dir))


@query
def best_converters(spark, sf_dir):
    return reports.best_converters(item_performance(spark, sf_dir))


@query
def traffic_without_sales(spark, sf_dir):
    return reports.traffic_without_sales(item_performance(spark, sf_dir))


@query
def top5_conversion(spark, sf_dir):
    return reports.top_by(item_performance(spark, sf_dir), "conversion_rate")


@query
def top5_revenue(spark, sf_dir):
    return reports.top_by(item_performance(spark, sf_dir), "revenue")


@query
def revenue_by_category(spark, sf_dir):
    return reports.revenue_by_category(item_performance(spark, sf_dir))


@query
def avg_revenue_by_category(spark, sf_dir):
    return reports.average_by(
        item_performance(spark, sf_dir), "item_category", "revenue", "cnt", "avg_revenue"
    )


@query
def avg_amount_by_supplier(spark, sf_dir):
    """Rows and mean amount per supplier, on order lines."""
    lines = shop_tables.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("supplier"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
    )
    return reports.average_by(lines, "supplier", "amount", "lines", "mean_amount")


@query
def email_validity(spark, sf_dir):
    return reports.email_validity(silver_users(spark, sf_dir))


@query
def bronze_channel_counts(spark, sf_dir):
    return reports.channel_counts(_view_facts(spark, sf_dir))


@query
def channel_filter(spark, sf_dir):
    return reports.on_channel(bronze_pageviews(spark, sf_dir), "view")


@query
def time_range_filter(spark, sf_dir):
    return reports.received_since(
        bronze_pageviews(spark, sf_dir), datetime(2024, 1, 10), datetime(2024, 1, 20)
    )


@query
def layer_row_counts(spark, sf_dir):
    return reports.row_counts(
        {
            "users": bronze_users(spark, sf_dir),
            "items": bronze_items(spark, sf_dir),
            "purchases": bronze_purchases(spark, sf_dir),
            "pageviews": _view_facts(spark, sf_dir),
        }
    )


@query
def sql_over_view(spark, sf_dir):
    """SQL text over a bound DataFrame; the whole result."""
    text = (
        "SELECT item_id, item_name, revenue, pageviews FROM shop_performance"
        " ORDER BY revenue DESC, item_id"
    )
    return reports.run_sql(spark, text, shop_performance=item_performance(spark, sf_dir))


@query
def first_record(spark, sf_dir):
    """The best-selling item turned on its side, one row per column."""
    best = gold.top_selling_items(_sales(spark, sf_dir), bronze_items(spark, sf_dir), k=1)
    return reports.as_record(best)


@query
def files_per_table(spark, sf_dir):
    """Rows in each data file behind the shop's sources."""
    counted = None
    for name in ("customer", "part", "events", "lineitem", "orders"):
        files = reports.rows_per_file(shop_tables.table(spark, sf_dir, name)).select(
            F.lit(name).alias("table_name"),
            F.element_at(F.split("file_path", "/"), -1).alias("file_name"),
            "record_count",
        )
        counted = files if counted is None else counted.unionByName(files)
    return counted


# --- round trips through files and the catalog ----------------------------------------------


def scratch_store(spark: SparkSession) -> LayerStore:
    """A store of its own below the shared folder."""
    root = new_folder(spark, "store")
    prefix = "ts_" + root.rsplit("-", 1)[1] + "_"
    return LayerStore(spark, root, prefix)


def _click_folder(spark, sf_dir):
    folder = os.path.join(new_folder(spark, "clicks"), "json")
    shop_tables.click_log(spark, sf_dir).write.json(folder)
    return folder


@query
def json_ingest(spark, sf_dir):
    """Click log written as newline JSON and ingested from there."""
    return bronze.pageviews(ndjson.read_clicks(spark, _click_folder(spark, sf_dir)))


@query
def stream_pageviews(spark, sf_dir):
    """The same ingest as a stream that takes what has arrived and stops."""
    stream = clicks.click_stream(spark, _click_folder(spark, sf_dir))
    work = new_folder(spark, "stream")
    clicks.ingest_available(stream, f"{work}/pageviews", f"{work}/checkpoint")
    return clicks.read_ingested(spark, f"{work}/pageviews")


@query
def partitioned_overwrite_roundtrip(spark, sf_dir):
    """Two overwrites of a day-partitioned table; only the second one's rows remain."""
    store = scratch_store(spark).create("bronze.pageviews")
    views = bronze_pageviews(spark, sf_dir)
    store.overwrite(reports.on_channel(views, "view"), "bronze.pageviews")
    store.overwrite(views, "bronze.pageviews")
    return store.read("bronze.pageviews")


@query
def partition_pruned_read(spark, sf_dir):
    """Last 24 hours read from a stored table: folders of older days stay closed."""
    store = scratch_store(spark).create("silver.purchases_enriched")
    store.overwrite(purchases_enriched(spark, sf_dir), "silver.purchases_enriched")
    start = F.lit(AS_OF.isoformat(" ")).cast("timestamp") - F.expr("INTERVAL 24 HOURS")
    stored = store.read("silver.purchases_enriched", since=start)
    return gold.sales_performance_24h(stored, AS_OF)


@query
def insert_values_roundtrip(spark, sf_dir):
    """A table filled from items, then given two literal rows."""
    store = scratch_store(spark).create_namespace("bronze")
    target = f"{store.namespace('bronze')}.notes"
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.sql(f"CREATE TABLE {target} (id BIGINT, msg STRING) USING parquet")
    bronze_items(spark, sf_dir).select("id", F.col("name").alias("msg")).write.insertInto(target)
    spark.sql(f"INSERT INTO {target} VALUES (-1, 'hello'), (-2, 'world')")
    return spark.sql(f"SELECT * FROM {target}")


@query
def segments_csv_roundtrip(spark, sf_dir):
    """Segments stored, exported as CSV from the stored table, and read from there."""
    store = scratch_store(spark).create(SEGMENTS)
    store.overwrite(user_engagement_segments(spark, sf_dir), SEGMENTS)
    folder = f"{store.root}/segmented_users"
    export_csv(store.read(SEGMENTS), folder)
    return read_export(spark, folder, CONTRACTS[SEGMENTS].schema)


@query
def report_csv(spark, sf_dir):
    """Revenue by category handed over as CSV."""
    report = revenue_by_category(spark, sf_dir)
    folder = os.path.join(new_folder(spark, "report"), "csv")
    # One row per category, so a single part.
    export_csv(report, folder, single_file=True)
    return read_export(spark, folder, report.schema)


def _sources(spark, sf_dir):
    return refresh.Sources(
        shop_tables.users(spark, sf_dir),
        shop_tables.items(spark, sf_dir),
        shop_tables.purchases(spark, sf_dir),
        shop_tables.click_log(spark, sf_dir),
    )


_BUILT: dict[tuple, LayerStore] = {}


def _built_once(spark, sf_dir, how: Callable) -> LayerStore:
    """A store built from the test tables, once per application and state of their files."""
    files = listing_of(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, files, how.__name__)
    if key not in _BUILT:
        _BUILT[key] = how(spark, sf_dir)
    return _BUILT[key]


def _refresh(spark, sf_dir) -> LayerStore:
    store = scratch_store(spark)
    refresh.refresh(store, _sources(spark, sf_dir), f"{store.root}/segmented_users", AS_OF)
    return store


def _refreshed(spark, sf_dir) -> LayerStore:
    """A store with all layers loaded from the test tables."""
    return _built_once(spark, sf_dir, _refresh)


@query
def full_refresh(spark, sf_dir):
    """All layers reloaded into the catalog; every table listed with its rows."""
    store = scratch_store(spark)
    refresh.refresh(store, _sources(spark, sf_dir), f"{store.root}/segmented_users", AS_OF, salts=4)
    counts = reports.row_counts({name: store.read(name) for name in CONTRACTS})
    listed = store.listing().select(F.concat_ws(".", "layer", "table_name").alias("t"))
    return listed.join(counts, "t")


def _stored_content(name: str) -> Query:
    def content(spark, sf_dir):
        return _refreshed(spark, sf_dir).read(name)

    content.__name__ = "refreshed_" + name.replace(".", "_")
    content.__doc__ = f"What a full refresh leaves in {name}."
    return content


for _name in CONTRACTS:
    if not _name.startswith("bronze."):
        query(_stored_content(_name))


@query
def backfill_24h(spark, sf_dir):
    """The 24-hour table as of an early day over the stored facts of all days."""
    moment = datetime(2024, 1, 10)
    start = F.lit(moment.isoformat(" ")).cast("timestamp") - F.expr("INTERVAL 24 HOURS")
    end = F.lit(moment.isoformat(" ")).cast("timestamp")
    stored = _refreshed(spark, sf_dir).read("silver.purchases_enriched", start, end)
    return gold.sales_performance_24h(stored, moment)


@query
def namespaces(spark, sf_dir):
    """Namespaces of the refreshed store with the number of their tables."""
    store = _refreshed(spark, sf_dir)
    tables = store.listing().groupBy("layer").agg(F.count(F.lit(1)).alias("tables"))
    return store.namespaces().join(tables, "layer")


def _served(spark, name: str, rows: DataFrame, text: str) -> DataFrame:
    """SQL over a stored table, named `{table}` in the text."""
    store = scratch_store(spark).create(name)
    store.overwrite(rows, name)
    return reports.run_sql(spark, text.format(table=store.table(name)))


@query
def serving_top_sellers(spark, sf_dir):
    text = "SELECT item_name, item_category, total_revenue FROM {table} ORDER BY total_revenue DESC"
    return _served(spark, "gold.top_selling_items", top_selling_items(spark, sf_dir), text)


@query
def serving_hours(spark, sf_dir):
    text = "SELECT purchase_hour, total_revenue FROM {table} ORDER BY purchase_hour"
    return _served(spark, "gold.sales_performance_24h", sales_performance_24h(spark, sf_dir), text)


@query
def serving_channels(spark, sf_dir):
    text = "SELECT channel, total_pageviews FROM {table} ORDER BY total_pageviews DESC, channel"
    return _served(spark, "gold.pageviews_by_channel", pageviews_by_channel(spark, sf_dir), text)


@query
def serving_row_count(spark, sf_dir):
    text = "SELECT count(*) AS row_count FROM {table}"
    return _served(spark, "gold.item_performance", item_performance(spark, sf_dir), text)


@query
def served_full_table(spark, sf_dir):
    """All of a stored table through SQL text, bound as a view and read again."""
    store = scratch_store(spark).create("gold.item_performance")
    store.overwrite(item_performance(spark, sf_dir), "gold.item_performance")
    text = f"SELECT item_id, revenue, pageviews FROM {store.table('gold.item_performance')}"
    reports.run_sql(spark, text, bind="served_items")
    return reports.run_sql(spark, "SELECT * FROM served_items")


@query
def count_parity(spark, sf_dir):
    """Every stored table counted through the catalog and straight from its files."""
    store = _refreshed(spark, sf_dir)
    files = {name: spark.read.parquet(store.location(name)) for name in CONTRACTS}
    return reports.count_parity({name: store.read(name) for name in CONTRACTS}, files)


@query
def content_parity(spark, sf_dir):
    """Every stored table's content through the catalog and straight from its files, compared
    by fingerprints per day (tables without days: as a whole)."""
    store = _refreshed(spark, sf_dir)
    found = []
    for name, contract in CONTRACTS.items():
        part = contract.partitioning
        day = part.expression() if part and part.transform == "day" else None
        files = spark.read.parquet(store.location(name))
        found.append(parity.content_parity(name, store.read(name), files, day))
    return reduce(DataFrame.unionByName, found)


# --- extensions -------------------------------------------------------------------------------


@query
def activity_merged(spark, sf_dir):
    """Segments from activity kept as day bits: states of two halves of the views that have
    days and users in common, merged."""
    views = _views(spark, sf_dir).where(F.col("received_at") <= F.lit(AS_OF.isoformat(" ")).cast("timestamp"))
    half = F.pmod(F.xxhash64("url", "received_at"), F.lit(2)) == 0
    one, other = (activity.states(views.where(side)) for side in (half, ~half))
    return gold.segments_of(silver_users(spark, sf_dir), activity.visits_of(activity.merged(one, other)), AS_OF)


@query
def hourly_exact(spark, sf_dir):
    return gold.hourly_revenue(_sales(spark, sf_dir), 24, AS_OF)


@query
def rfm_full(spark, sf_dir):
    return gold.rfm_segments(
        silver_users(spark, sf_dir), _views(spark, sf_dir), _sales(spark, sf_dir),
        spender_minimum=200, as_of=AS_OF,
    )


@query
def quality_gates(spark, sf_dir):
    """Gates over stored tables: one narrow scan each, no lookup is computed again."""
    stored = _refreshed(spark, sf_dir).read
    checked = {
        "silver.users": ("id", ["email", "full_name"]),
        "silver.items": ("id", ["name", "price"]),
        "silver.purchases_enriched": ("id", ["total_price", "user_email", "item_name"]),
        "silver.pageviews_by_items": (None, ["item_id", "item_name"]),
        "bronze.users": ("id", ["email"]),
        "bronze.purchases": ("id", ["quantity"]),
    }
    return quality.all_gates(
        *(quality.gates(stored(name), name, key, required) for name, (key, required) in checked.items())
    )


@query
def table_layouts(spark, sf_dir):
    """Columns, types and folder columns of the thirteen stored tables, as the catalog has
    them, with the rows and folders that each holds."""
    store = _refreshed(spark, sf_dir)
    found = []
    for name, contract in CONTRACTS.items():
        part = contract.partitioning
        columns = store.columns(name).select(F.lit(name).alias("t"), "column", "type", "is_folder")
        rows = spark.table(store.table(name))
        folders = F.lit(0)
        if part:
            value = F.coalesce(F.col(part.column).cast("string"), F.lit(""))
            folders = rows.agg(F.count_distinct(value)).scalar()
        found.append(columns.select("*", rows.agg(F.count(F.lit(1))).scalar().alias("n"), folders.cast("long").alias("folders")))
    return reduce(DataFrame.unionByName, found)


@query
def listing_after_drop(spark, sf_dir):
    """Two stored tables of which one is dropped; the one left, with its rows."""
    store = scratch_store(spark).create("bronze.users", "bronze.items")
    store.overwrite(bronze_users(spark, sf_dir), "bronze.users")
    store.overwrite(bronze_items(spark, sf_dir), "bronze.items")
    store.drop("bronze.items")
    rows = store.read("bronze.users").agg(F.count(F.lit(1))).scalar()
    return store.listing().withColumn("n", rows)


@query
def rejected_values(spark, sf_dir):
    """Values and lines that a load into bronze cannot keep, counted in the sources:
    quantities that are no numbers, and log lines that are cut off."""
    spoilt = F.expr("CASE WHEN id % 10 = 3 THEN concat(quantity, ' pcs') ELSE CAST(quantity AS STRING) END")
    purchases = shop_tables.purchases(spark, sf_dir).withColumn("quantity", spoilt)
    folder = os.path.join(new_folder(spark, "cut"), "json")
    log = shop_tables.click_log(spark, sf_dir)
    line = F.to_json(F.struct(*log.columns))
    cut = F.when(F.col("channel") == "signup", F.substring(line, 1, 20)).otherwise(line)
    log.select(cut.alias("value")).write.text(folder)
    clicks_read = ndjson.read_clicks(spark, folder)
    return quality.all_gates(
        quality.lost_values(purchases, CONTRACTS["bronze.purchases"]),
        quality.lost_values(clicks_read, CONTRACTS["bronze.pageviews"]),
        quality.gates(bronze.purchases(purchases), "bronze.purchases", "id", ["quantity"]),
    )


def _delivery(items: DataFrame) -> DataFrame:
    """A later delivery: a third of the items newer and dearer, some of them in another
    category; a sixth older than what is stored; new items; items without a number. The
    other items are absent."""
    dearer = (F.col("price") + F.lit("0.10").cast(PRICE)).cast(PRICE)
    later = F.col("updated_at") + F.expr("INTERVAL 1 DAY")
    moved = F.expr("CASE WHEN id % 9 = 0 THEN 'moved' ELSE category END")
    newer = items.where("id % 3 = 0").withColumns(
        {"price": dearer, "updated_at": later, "category": moved}
    )
    earlier = F.col("updated_at") - F.expr("INTERVAL 1 DAY")
    older = items.where("id % 6 = 1").withColumns({"name": F.lit("old"), "updated_at": earlier})
    new = items.where("id % 7 = 0").withColumn("id", F.col("id") + 1_000_000)
    nameless = items.where("id % 50 = 0").withColumn("id", F.lit(None).cast("long"))
    return newer.unionByName(older).unionByName(new).unionByName(nameless)


@query
def latest_per_key(spark, sf_dir):
    """Incremental load: a mixed delivery, repeated by a replay, upserted."""
    first = bronze_items(spark, sf_dir)
    keyed = _delivery(first).where("id IS NOT NULL")
    return upsert(first, _delivery(first).unionByName(keyed), ["id"], ["updated_at"])


def _item_history(spark, sf_dir):
    """A load of items and the delivery applied to it as an increment."""
    loads = history.LoadHistory(spark, os.path.join(new_folder(spark, "history"), "items"))
    first = bronze_items(spark, sf_dir)
    loads.add(first, 1, datetime(2024, 1, 1))
    loads.add_increment(_delivery(first), ["id"], ["updated_at"], 2, datetime(2024, 1, 2))
    return loads


@query
def incremental_load(spark, sf_dir):
    """A stored load of items with the delivery applied as an increment."""
    return _item_history(spark, sf_dir).as_of(datetime(2024, 1, 3))


@query
def stored_upsert(spark, sf_dir):
    """The delivery applied to the stored table: only touched folders are rewritten."""
    store = scratch_store(spark).create("bronze.items")
    first = bronze_items(spark, sf_dir)
    store.overwrite(first, "bronze.items")
    store.upsert(_delivery(first), "bronze.items", ["id"], ["updated_at"])
    return store.read("bronze.items")


# --- layers maintained by deliveries ------------------------------------------------------------


def _between(rows: DataFrame, time: str, first: str, last: str) -> DataFrame:
    return rows.where(f"{time} >= TIMESTAMP'{first}' AND {time} < TIMESTAMP'{last}'")


def _three_deliveries(spark, sf_dir) -> LayerStore:
    """Ten days loaded in full, the others in three mixed deliveries: new facts, items and
    users; corrected purchases, some of another item; changed labels, folders and addresses;
    older versions and replays, which change nothing."""
    source = _sources(spark, sf_dir)
    users, items = source.users, source.items
    bought = lambda first, last: _between(source.purchases, "created_at", first, last)
    views = bronze.pageviews(source.pageviews)
    seen = lambda first, last: _between(views, "received_at", first, last)
    later = lambda rows, days: rows.withColumn("updated_at", F.expr(f"updated_at + INTERVAL {days} DAY"))
    begin, tenth, middle, late, end = "1970-01-01", "2024-01-10", "2024-01-17", "2024-01-24", "9999-01-01"
    store = scratch_store(spark)
    refresh.refresh(
        store, refresh.Sources(users, items, bought(begin, tenth), seen(begin, tenth)),
        f"{store.root}/segmented_users", datetime(2024, 1, 10),
    )
    layers = incremental.IncrementalLayers(store)
    layers.start(datetime(2024, 1, 10))
    layers.apply(1, incremental.Delivery(
        items=_delivery(items).where("id IS NOT NULL"), purchases=bought(tenth, middle), pageviews=seen(tenth, middle),
    ), datetime(2024, 1, 17))
    earlier = bought(begin, middle)
    corrected = later(earlier.where("id % 10 = 0"), 1).withColumn("quantity", F.expr("quantity + 1"))
    moved = later(earlier.where("id % 10 = 5"), 1).withColumn("item_id", F.col("item_id") + 1)
    older = later(earlier.where("id % 10 = 3"), -1).withColumn("quantity", F.lit(99))
    swapped = F.expr("CASE WHEN email IS NULL THEN concat('n', id, '@example.com') END")
    corrections = corrected.unionByName(moved).unionByName(older).unionByName(earlier.where("id % 10 = 7"))
    layers.apply(2, incremental.Delivery(
        users=later(users.where("id % 4 = 0"), 1).withColumn("email", swapped),
        purchases=corrections.unionByName(bought(middle, late)), pageviews=seen(middle, late),
    ), AS_OF)
    renamed = later(items.where("id % 11 = 0"), 2).withColumn("name", F.concat("name", F.lit("!")))
    layers.apply(3, incremental.Delivery(
        items=renamed, purchases=bought(late, end).unionByName(corrections), pageviews=seen(late, end),
    ), AS_OF)
    return store


def _maintained(name: str) -> Query:
    def content(spark, sf_dir):
        return _built_once(spark, sf_dir, _three_deliveries).read(name)

    content.__name__ = "maintained_" + name.split(".")[1]
    content.__doc__ = f"{name} after a full load and three mixed deliveries."
    return content


for _name in CONTRACTS:
    if _name.startswith("gold.") or "_" in _name:
        query(_maintained(_name))


# --- what comes in: objects, streams, audited versions -------------------------------------------


def _log_objects(rows: DataFrame, folder: str, name: str) -> None:
    """Bronze page views as one delivery of click objects."""
    rows.withColumn("received_at", F.unix_timestamp("received_at")).write.json(f"{folder}/{name}")


@query
def incremental_ingest(spark, sf_dir):
    """Click objects that arrive in three lots; each load reads the objects of its own lot."""
    views, work = bronze_pageviews(spark, sf_dir), new_folder(spark, "objects")
    ingest = ClickIngest(spark, f"{work}/ingested")
    cuts = ("1970-01-01", "2024-01-10", "2024-01-20", "9999-01-01")
    for load, (first, last) in enumerate(zip(cuts, cuts[1:]), start=1):
        _log_objects(_between(views, "received_at", first, last), f"{work}/log", f"lot={load}")
        ingest.take(f"{work}/log", load)
    return ingest.all_rows()


@query
def stream_deduplicated(spark, sf_dir):
    """The click log as a stream, started three times: with replays, and with a late lot that
    is kept apart. The rows taken, and the late ones."""
    views, work = bronze_pageviews(spark, sf_dir), new_folder(spark, "replayed")
    table = clicks.ClickTable(spark, f"{work}/clicks", "3 days")
    lot = lambda first, last: _between(views, "received_at", first, last)
    late = lot("1970-01-01", "2024-01-05").withColumn("url", F.lit("/late"))
    lots = (
        lot("1970-01-01", "2024-01-20"),
        lot("2024-01-18", "9999-01-01").unionByName(lot("2024-01-19", "9999-01-01")),
        lot("2024-01-29", "9999-01-01").unionByName(late),
    )
    for n, rows in enumerate(lots):
        _log_objects(rows, f"{work}/log", f"lot={n}")
        stream = clicks.click_stream(spark, f"{work}/log/*", files_per_batch=10_000)
        table.ingest_available(stream, f"{work}/checkpoint")
    taken = table.rows().withColumn("place", F.lit("taken"))
    return taken.unionByName(table.late().withColumn("place", F.lit("late")))


@query
def audited_publish(spark, sf_dir):
    """Purchases published after an audit; rows that break a rule are set apart, and a second
    version with doubled ids is written, fails its gate and is not shown."""
    store = scratch_store(spark)
    rules = {"quantity": F.col("quantity") > 1, "price": F.col("purchase_price") < 500}
    table = AuditedTable(store, "bronze.purchases", rules)
    bought = bronze_purchases(spark, sf_dir)
    gates = lambda rows: quality.gates(rows, "bronze.purchases", "id", ["id"])
    table.load(bought, 1, gates)
    try:
        table.load(bought.unionByName(bought), 2, gates)
    except quality.GateFailed:
        pass
    else:
        raise AssertionError("doubled ids have passed the gate")
    narrow = ("id", "quantity", "purchase_price")
    shown = table.read().select(*narrow, F.lit("published").alias("place"), F.lit(0).cast("long").alias("version"))
    apart = table.quarantine().select(*narrow, F.col("rejected_by").alias("place"), "version")
    return shown.unionByName(apart)


@query
def as_of_load(spark, sf_dir):
    """Items as they stood between two loads."""
    return _item_history(spark, sf_dir).as_of(datetime(2024, 1, 1, 12))


@query
def interval_history(spark, sf_dir):
    """Items after each of four loads (whole, delivery, whole with rows missing, whole), read
    as of a moment after it from validity intervals."""
    first = bronze_items(spark, sf_dir)
    path = os.path.join(new_folder(spark, "intervals"), "items")
    loads = IntervalHistory(spark, path, CONTRACTS["bronze.items"].schema)
    loads.add(first, 1, datetime(2024, 1, 1))
    loads.add_increment(_delivery(first), ["id"], ["updated_at"], 2, datetime(2024, 1, 2))
    delivered = loads.version(2)
    loads.add(first.where("id % 4 <> 1"), 3, datetime(2024, 1, 3))
    loads.add(delivered, 4, datetime(2024, 1, 4))
    return reduce(
        DataFrame.unionByName,
        (loads.as_of(datetime(2024, 1, n, 12)).withColumn("load_id", F.lit(n).cast("long")) for n in (1, 2, 3, 4)),
    )


@query
def load_log(spark, sf_dir):
    """Commit time, operation and size of both loads."""
    return _item_history(spark, sf_dir).log()


@query
def schema_evolution(spark, sf_dir):
    """Page views stored before a column was added, under its first name, and under
    its present name, read as one table."""
    folder = new_folder(spark, "evolution")
    views = bronze_pageviews(spark, sf_dir)
    agent = F.concat(F.lit("agent-"), F.col("channel"))
    steps = {
        "v1": views,
        "v2": views.withColumn("user_agent", agent),
        "v3": views.drop("channel").withColumn("ua", F.lit("agent-3")),
    }
    for step, rows in steps.items():
        rows.write.mode("overwrite").parquet(f"{folder}/{step}")
    text = T.StringType()
    columns = {
        "user_id": (T.LongType(), []),
        "url": (text, []),
        "ua": (text, ["user_agent"]),
        "received_at": (T.TimestampType(), []),
    }
    return history.read_evolved(spark, [f"{folder}/{step}" for step in steps], columns)


@query
def compaction(spark, sf_dir):
    """Page views stored in many small files, rewritten into few."""
    folder = new_folder(spark, "compaction")
    views = bronze_pageviews(spark, sf_dir)
    views.repartition(32).write.mode("overwrite").parquet(f"{folder}/small")
    history.compact(spark.read.parquet(f"{folder}/small"), f"{folder}/fuller")
    return spark.read.parquet(f"{folder}/fuller")
