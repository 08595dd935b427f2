"""Silver and gold kept up to date from deliveries, without reading the facts again.

A delivery becomes signed rows: -1 for a row that goes, +1 for one that comes. What gold
sums is kept as small states (per item, per user and day, per channel); signed rows are
summed into them, and only the gold rows whose sums or labels changed are written again.
Every step of a load is staged in its ledger, so a load that died is started again with the
same number and goes on from there; a load that is done is not done twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.contracts import CONTRACTS
from tierstone.functions import clock, shop
from tierstone.operators.latest import CHANGE, changes
from tierstone.plans import bronze, gold, silver
from tierstone.sinks.ledger import Ledger
from tierstone.sinks.store import LayerStore

SEGMENTS = "gold.user_engagement_segments"
#: Tables with a key; page views have none and are only added.
KEYED = ("users", "items", "purchases")
_ITEM_SUMS = ("sales", "sold", "ordered", "priced", "earned", "viewed")


@dataclass(frozen=True)
class Delivery:
    """What has arrived since the last load, in the shape of the sources; None for nothing."""

    users: DataFrame | None = None
    items: DataFrame | None = None
    purchases: DataFrame | None = None
    pageviews: DataFrame | None = None


def _signed(value: Column) -> Column:
    return F.when(F.col(CHANGE) > 0, value).otherwise(-value)


def item_sums(purchases: DataFrame, views: DataFrame) -> DataFrame:
    """What signed narrow facts add per item: purchases (`sales`), their quantities, ids,
    priced rows and totals, and product page views."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    money = purchases.schema["total_price"].dataType
    sales = purchases.select(
        "item_id", CHANGE, one.alias("sales"), F.coalesce(F.col("quantity").cast("long"), none).alias("sold"),
        F.col("id").isNotNull().cast("long").alias("ordered"), F.col("total_price").isNotNull().cast("long").alias("priced"),
        F.coalesce("total_price", F.lit(0).cast(money)).alias("earned"), none.alias("viewed"),
    )
    seen = views.where(F.col("page") == shop.PRODUCT_PAGE).select(
        "item_id", CHANGE, *(none.alias(c) for c in ("sales", "sold", "ordered", "priced")),
        F.lit(0).cast(money).alias("earned"), one.alias("viewed"),
    )
    return _summed(sales.unionByName(seen), ["item_id"], _ITEM_SUMS, signed=True)


def user_days(views: DataFrame) -> DataFrame:
    """What signed views add per user and day: rows, and rows with a page."""
    one = F.lit(1).cast("long")
    per_row = views.where(F.col("user_id").isNotNull()).select(
        "user_id", F.to_date("received_at").alias("day"), CHANGE, one.alias("views"),
        F.col("page").isNotNull().cast("long").alias("pages"),
    )
    return _summed(per_row, ["user_id", "day"], ("views", "pages"), signed=True)


def channel_sums(views: DataFrame) -> DataFrame:
    per_row = views.select("channel", CHANGE, F.lit(1).cast("long").alias("views"))
    return _summed(per_row, ["channel"], ("views",), signed=True)


def _summed(rows: DataFrame, keys: Sequence[str], measures: Sequence[str], signed: bool = False) -> DataFrame:
    """Sums per key, in a type that holds any sum of them."""
    wide = {"earned": "decimal(28,2)"}
    total = lambda m: F.sum(_signed(F.col(m)) if signed else F.col(m)).cast(wide.get(m, "bigint"))
    return rows.groupBy(*keys).agg(*(total(m).alias(m) for m in measures))


def merged(state: DataFrame, delta: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """A state with a delta summed in; keys whose sums are all back at zero are dropped."""
    both = _summed(state.unionByName(delta), keys, measures)
    return both.where(reduce(Column.__or__, [F.col(m) != 0 for m in measures]))


def as_performance_sums(items: DataFrame) -> DataFrame:
    """The state per item as `gold.performance_of` takes it: NULL where no row contributed."""
    sold = F.col("sales") > 0
    return items.where(F.col("item_id").isNotNull()).select(
        "item_id", F.when(sold, F.col("sold")).alias("sold"), F.when(sold, F.col("ordered")).alias("ordered"),
        F.when(F.col("priced") > 0, F.col("earned")).alias("earned"),
        F.when(F.col("viewed") > 0, F.col("viewed")).alias("viewed"),
    )


def as_visits(days: DataFrame) -> DataFrame:
    """The state per user and day as `gold.segments_of` takes it."""
    return days.groupBy("user_id").agg(
        F.sum("pages").alias("page_count"), F.count(F.lit(1)).alias("day_count"), F.max("day").alias("last_day")
    )


def _same(one: DataFrame, other: DataFrame, pairs: dict[str, str]) -> Column:
    return reduce(Column.__and__, [one[a].eqNullSafe(other[b]) for a, b in pairs.items()])


class IncrementalLayers:
    """Layers of a store, maintained by numbered loads. Load 0 takes the states from silver as
    a full refresh left it; each later load builds on the one before."""

    def __init__(self, store: LayerStore) -> None:
        self.store, self.spark = store, store.spark

    def ledger(self, load: int) -> Ledger:
        return Ledger(self.spark, f"{self.store.root}/_loads/load_id={load}")

    def start(self, as_of: datetime | None = None) -> None:
        """States of what silver holds; `as_of` is the moment gold was last built for."""
        ledger, plus = self.ledger(0), F.lit(1)
        sales = self.store.read("silver.purchases_enriched").withColumn(CHANGE, plus)
        views = self.store.read("silver.pageviews_by_items").withColumn(CHANGE, plus)
        ledger.staged("state_items", lambda: item_sums(sales, views))
        ledger.staged("state_days", lambda: user_days(views))
        ledger.staged("state_channels", lambda: channel_sums(views))
        self._moment(ledger, as_of)
        ledger.once("done", lambda: None)

    def _moment(self, ledger: Ledger, as_of: datetime | None) -> None:
        text = None if as_of is None else as_of.isoformat(" ")
        ledger.staged("moment", lambda: self.spark.range(1).select(F.lit(text).cast("string").alias("as_of")))

    def apply(self, load: int, delivery: Delivery, as_of: datetime | None = None) -> None:
        """Take a delivery through bronze, silver and gold.

        `as_of` bounds the time-dependent tables as in a full refresh. Where it differs from the
        last load's, every user's recency changes and the segments are written as a whole,
        from the states; otherwise only those of users with new or changed rows.
        """
        ledger, before = self.ledger(load), self.ledger(load - 1)
        if ledger.is_done("done"):
            return
        if not before.is_done("done"):
            raise ValueError(f"load {load - 1} is not complete")
        signed = self._changes(ledger, delivery)
        for name in (*KEYED, "pageviews"):
            ledger.once(f"bronze_{name}", lambda name=name: self._replace(ledger, f"bronze.{name}", signed[name]))
        ledger.once("silver_users", lambda: self._replace(ledger, "silver.users", silver.users(signed["users"])))
        ledger.once("silver_items", lambda: self._replace(ledger, "silver.items", silver.items(signed["items"])))
        self._silver_facts(ledger, signed)
        self._gold(ledger, before, signed, as_of)
        ledger.once("done", lambda: None)

    def _changes(self, ledger: Ledger, delivery: Delivery) -> dict[str, DataFrame]:
        """Signed bronze rows of every table."""
        signed = {}
        for name in (*KEYED, "pageviews"):
            arrived = getattr(delivery, name)

            def build(name: str = name, arrived: DataFrame | None = arrived) -> DataFrame:
                contract = CONTRACTS[f"bronze.{name}"]
                if arrived is None:
                    return self.spark.createDataFrame([], contract.schema).withColumn(CHANGE, F.lit(1))
                rows = getattr(bronze, name)(arrived)
                if name not in KEYED:
                    return rows.withColumn(CHANGE, F.lit(1))
                return changes(self.store.read(contract.name), rows, ["id"], ["updated_at"])

            signed[name] = ledger.staged(f"changes_{name}", build)
        return signed

    def _replace(self, ledger: Ledger, name: str, signed: DataFrame) -> None:
        """Rows that come in the place of those that go, which have their id."""
        if signed.isEmpty():
            return
        comes = signed.where(F.col(CHANGE) > 0)
        among = signed.where(F.col(CHANGE) < 0).select("id").distinct() if "id" in signed.columns else None
        step = "content_" + name.replace(".", "_")
        self.store.replace(comes, name, among, lambda build: ledger.staged(step, build))

    def _silver_facts(self, ledger: Ledger, signed: dict[str, DataFrame]) -> None:
        """Day folders of silver facts that changed rows or changed labels fall into."""
        store = self.store
        users, items = store.read("bronze.users"), store.read("bronze.items")
        emails = _relabelled(signed["users"], ["email"])
        labels = _relabelled(signed["items"], ["name", "category"])
        for name, source, time, keys in (
            ("silver.purchases_enriched", "bronze.purchases", "created_at", (("user_id", emails), ("item_id", labels))),
            ("silver.pageviews_by_items", "bronze.pageviews", "received_at", (("item_id", labels),)),
        ):
            part = CONTRACTS[name].partitioning.column
            stored = self.spark.table(store.table(name))
            touched = [signed[source.split(".")[1]].select(F.to_date(time).alias("day"))]
            for key, ids in keys:
                known = stored.join(ids, stored[key] == ids["id"], "left_semi")
                touched.append(known.select(F.col(part).alias("day")))

            def build(touched: list[DataFrame] = touched) -> DataFrame:
                return reduce(DataFrame.unionByName, touched).distinct()

            step = name.replace(".", "_")
            # One row per day folder touched.
            days = [r["day"] for r in ledger.staged(f"days_{step}", build).collect()]
            if not days:
                continue

            def refill(name: str = name, source: str = source, days: list = days) -> None:
                rows = store.read_folders(source, days)
                plan = (
                    silver.purchases_enriched(rows, users, items) if source == "bronze.purchases"
                    else silver.pageviews_by_items(rows, items)
                )
                store.refill(plan, name, days)

            ledger.once(step, refill)

    def _gold(self, ledger: Ledger, before: Ledger, signed: dict[str, DataFrame], as_of: datetime | None) -> None:
        store, read = self.store, self.store.read
        sales, views = silver.priced(signed["purchases"]), silver.item_views(signed["pageviews"], CHANGE)
        delta = {
            "items": ledger.staged("delta_items", lambda: item_sums(sales, views)),
            "days": ledger.staged("delta_days", lambda: user_days(views)),
            "channels": ledger.staged("delta_channels", lambda: channel_sums(views)),
        }
        shapes = {"items": (["item_id"], _ITEM_SUMS), "days": (["user_id", "day"], ("views", "pages")),
                  "channels": (["channel"], ("views",))}
        state = {}
        for name, (keys, measures) in shapes.items():
            old = self.spark.read.parquet(before.folder(f"state_{name}"))
            state[name] = ledger.staged(
                f"state_{name}", lambda o=old, n=name, k=keys, m=measures: merged(o, delta[n], k, m)
            )
        self._moment(ledger, as_of)

        def performance() -> None:
            ids = delta["items"].select("item_id").unionByName(signed["items"].select(F.col("id").alias("item_id"))).distinct()
            if ids.isEmpty():
                return
            catalogue = read("silver.items")
            catalogue = catalogue.join(ids, _same(catalogue, ids, {"id": "item_id"}), "left_semi")
            sums = state["items"].join(ids, "item_id", "left_semi")
            store.replace(
                gold.performance_of(catalogue, as_performance_sums(sums)), "gold.item_performance", ids,
                lambda build: ledger.staged("content_performance", build),
            )

        def segments() -> None:
            users, days = read("silver.users"), self._days_until(state["days"], as_of)
            if before_moment == moment:
                ids = delta["days"].select("user_id").unionByName(signed["users"].select(F.col("id").alias("user_id"))).distinct()
                if ids.isEmpty():
                    return
                users = users.join(ids, _same(users, ids, {"id": "user_id"}), "left_semi")
                rows = gold.segments_of(users, as_visits(days.join(ids, "user_id", "left_semi")), as_of)
                store.replace(rows, SEGMENTS, ids, lambda build: ledger.staged("content_segments", build))
            else:
                store.overwrite(gold.segments_of(users, as_visits(days), as_of), SEGMENTS)

        sold = state["items"].where("sales > 0").select("item_id", F.expr("CASE WHEN priced > 0 THEN earned END").alias("total_price"))
        revenue = gold.labelled_revenue(sold, read("bronze.items"))
        end = None if as_of is None else clock.now(as_of)
        last_day = read("silver.purchases_enriched", clock.hours_before(24, as_of), end)
        channels = state["channels"].select("channel", F.col("views").alias("total_pageviews"))
        moment, before_moment = (x.staged("moment", lambda: None).first()["as_of"] for x in (ledger, before))
        ledger.once("gold_performance", performance)
        ledger.once("gold_top", lambda: store.overwrite(gold.top_revenue(revenue), "gold.top_selling_items"))
        ledger.once(
            "gold_day", lambda: store.overwrite(gold.sales_performance_24h(last_day, as_of), "gold.sales_performance_24h")
        )
        ledger.once("gold_channels", lambda: store.overwrite(channels, "gold.pageviews_by_channel"))
        ledger.once("gold_segments", segments)

    def _days_until(self, days: DataFrame, as_of: datetime | None) -> DataFrame:
        """Days before `as_of`, and of its own day what has been seen until then; only that
        day's folder is opened."""
        if as_of is None:
            return days
        start = F.date_trunc("day", clock.now(as_of))
        today = self.store.read("silver.pageviews_by_items", start, clock.now(as_of)).withColumn(CHANGE, F.lit(1))
        return days.where(F.col("day") < clock.today(as_of)).unionByName(user_days(today))


def _relabelled(signed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Ids that are new or whose columns differ between the row that goes and the one that comes."""
    shown = F.struct(*columns)
    goes, comes = (F.max(F.when(F.col(CHANGE) == s, shown)) for s in (-1, 1))
    met = signed.where(F.col("id").isNotNull()).groupBy("id").agg(goes.alias("goes"), comes.alias("comes"))
    return met.where(~F.equal_null("goes", "comes")).select("id")
