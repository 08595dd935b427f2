"""Full reload of all layers, source to gold."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from tierstone.contracts import CONTRACTS
from tierstone.functions import clock
from tierstone.plans import bronze, gold, quality, silver
from tierstone.sinks.csv import export_csv
from tierstone.sinks.store import LayerStore

SEGMENTS = "gold.user_engagement_segments"


@dataclass(frozen=True)
class Sources:
    users: DataFrame
    items: DataFrame
    purchases: DataFrame
    pageviews: DataFrame


def load_bronze(store: LayerStore, sources: Sources) -> dict[str, int]:
    """All sources into bronze. Any click object may hold events of every day, so facts
    are regrouped by day like everything else."""
    loads = {
        "bronze.users": bronze.users(sources.users),
        "bronze.items": bronze.items(sources.items),
        "bronze.purchases": bronze.purchases(sources.purchases),
        "bronze.pageviews": bronze.pageviews(sources.pageviews),
    }
    return {name: store.overwrite(rows, name) for name, rows in loads.items()}


def bronze_gates(store: LayerStore, sources: Sources) -> DataFrame:
    """What is missing in bronze, and how many source values the load could not keep."""
    shape = {
        "bronze.users": (sources.users, "id", ["id"]),
        "bronze.items": (sources.items, "id", ["id", "name", "price"]),
        "bronze.purchases": (sources.purchases, "id", ["id", "quantity", "created_at"]),
        "bronze.pageviews": (sources.pageviews, None, ["url", "received_at"]),
    }
    results = []
    for name, (source, key, required) in shape.items():
        results.append(quality.gates(store.read(name), name, key, required))
        results.append(quality.lost_values(source, CONTRACTS[name]))
    return quality.all_gates(*results)


def build_silver(store: LayerStore, salts: int = 1) -> dict[str, int]:
    users, items = store.read("bronze.users"), store.read("bronze.items")
    purchases, pageviews = store.read("bronze.purchases"), store.read("bronze.pageviews")
    return {
        name: store.overwrite(rows, name)
        for name, rows in {
            "silver.users": silver.users(users),
            "silver.items": silver.items(items),
            "silver.purchases_enriched": silver.purchases_enriched(purchases, users, items, salts),
            "silver.pageviews_by_items": silver.pageviews_by_items(pageviews, items, salts),
        }.items()
    }


def build_gold(store: LayerStore, as_of: datetime | None = None) -> dict[str, int]:
    users, items = store.read("silver.users"), store.read("silver.items")
    sales = store.read("silver.purchases_enriched")
    views = store.read("silver.pageviews_by_items")
    end = None if as_of is None else clock.now(as_of)
    last_day = store.read("silver.purchases_enriched", clock.hours_before(24, as_of), end)
    seen = views if end is None else store.read("silver.pageviews_by_items", until=end)
    return {
        name: store.overwrite(rows, name)
        for name, rows in {
            "gold.item_performance": gold.item_performance(items, sales, views),
            "gold.top_selling_items": gold.top_selling_items(sales),
            "gold.sales_performance_24h": gold.sales_performance_24h(last_day, as_of),
            "gold.pageviews_by_channel": gold.pageviews_by_channel(views),
            SEGMENTS: gold.user_engagement_segments(users, seen, as_of),
        }.items()
    }


def refresh(
    store: LayerStore,
    sources: Sources,
    csv_path: str,
    as_of: datetime | None = None,
    enforce: bool = False,
    salts: int = 1,
    single_csv: bool = False,
) -> dict[str, int]:
    """Create, load and build everything in order, then hand the segments over as
    CSV from the stored table. Returns the rows stored per table.

    With `enforce`, a failed gate on bronze stops the run before silver is touched, so
    bad data does not spread. `salts` spreads hot keys of the silver lookups.
    """
    store.create()
    stored = load_bronze(store, sources)
    if enforce:
        quality.enforce(bronze_gates(store, sources))
    stored |= build_silver(store, salts) | build_gold(store, as_of)
    export_csv(store.read(SEGMENTS), csv_path, single_csv)
    return stored
