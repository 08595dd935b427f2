"""Layers maintained by deliveries against full refreshes of the same sources."""

import glob
import os
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tierstone.contracts import CONTRACTS
from tierstone.plans import incremental, refresh
from tierstone.plans.incremental import Delivery, IncrementalLayers
from tierstone.sinks.ledger import Ledger
from tierstone.sinks.store import LayerStore

AS_OF = datetime(2024, 1, 20, 12)
DAY = datetime(2024, 1, 10, 9)


@pytest.fixture
def stores(spark, tmp_path, request):
    made = []

    def new(label):
        store = LayerStore(spark, str(tmp_path / label), f"inc_{label}_")
        made.append(store)
        return store

    yield new
    for store in made:
        for layer in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE IF EXISTS {store.namespace(layer)} CASCADE")


def user(i, email, at=DAY):
    return (i, "F", str(i), email, DAY, at)


def item(i, category, price="5.00", name=None, at=DAY):
    return (i, name or f"item {i}", category, Decimal(price), 1, DAY, at)


def purchase(i, user_id, item_id, quantity, price="2.00", created=DAY, at=DAY):
    return (i, user_id, item_id, quantity, None if price is None else Decimal(price), created, at)


def view(user_id, url, channel="x", at=DAY):
    return (user_id, url, channel, at)


class Source:
    """What the shop database and the click log hold in the end."""

    def __init__(self, spark):
        self.spark = spark
        self.tables = {"users": {}, "items": {}, "purchases": {}, "pageviews": []}

    def take(self, **parts):
        for name, rows in parts.items():
            if name == "pageviews":
                self.tables[name] += rows
                continue
            for row in rows:
                old = self.tables[name].get(row[0])
                if old is None or row[-1] >= old[-1]:
                    self.tables[name][row[0]] = row
        return Delivery(**{name: self.frame(name, rows) for name, rows in parts.items()})

    def frame(self, name, rows):
        return self.spark.createDataFrame(rows, CONTRACTS[f"bronze.{name}"].schema)

    def sources(self):
        rows = {n: t if isinstance(t, list) else list(t.values()) for n, t in self.tables.items()}
        return refresh.Sources(**{n: self.frame(n, r) for n, r in rows.items()})


def first_load(source):
    source.take(
        users=[user(1, "a@example.com"), user(2, None), user(3, "c@example.com"), user(4, "d@example.com")],
        items=[item(1, "a"), item(2, "b"), item(3, "c"), item(4, "d")],
        purchases=[purchase(1, 1, 1, 2), purchase(2, 1, 2, 1), purchase(3, 9, 99, 1), purchase(4, 3, None, 1, None)],
        pageviews=[view(1, "/products/1"), view(1, "/products/2", "y"), view(3, "/cart/3"), view(None, "/products/1"),
                   view(1, "/about"), view(4, "/products/1", "z", datetime(2024, 1, 20, 11))],
    )


def files(store, name):
    folder = store.location(name).removeprefix("file:")
    return {os.path.relpath(f, folder): os.path.getmtime(f) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


def assert_equal(store, full):
    for name in CONTRACTS:
        assert rows_of(store.read(name)) == rows_of(full.read(name)), name


def test_three_deliveries_equal_a_full_refresh(spark, stores, tmp_path):
    source, store = Source(spark), stores("kept")
    first_load(source)
    refresh.refresh(store, source.sources(), str(tmp_path / "csv0"), AS_OF)
    layers = IncrementalLayers(store)
    layers.start(AS_OF)
    later = lambda n: DAY + timedelta(days=n)
    before = files(store, "gold.item_performance")
    # A correction that moves a purchase to another item and day, an older version, new facts.
    layers.apply(1, source.take(
        purchases=[purchase(2, 1, 1, 4, created=later(1), at=later(1)), purchase(1, 1, 1, 50, at=later(-1)),
                   purchase(5, 3, 1, 1, created=datetime(2024, 1, 20, 3), at=later(1))],
        pageviews=[view(1, "/products/1", "x", later(n)) for n in range(9)] + [view(4, "/products/2", "new", later(1))],
    ), AS_OF)
    after = files(store, "gold.item_performance")
    kept = [f for f in before if f.startswith(("part_item_category=C/", "part_item_category=D/"))]
    assert len(kept) == 2 and all(after[f] == before[f] for f in kept)
    # Labels and addresses change, an item changes folder, one is new; a purchase leaves its item.
    layers.apply(2, source.take(
        users=[user(1, None, later(2)), user(2, "b@example.com", later(2)), user(7, "g@example.com", later(2))],
        items=[item(1, "d", "7.00", "renamed", later(2)), item(9, "a"), item(3, "c", "1.00", at=later(-3))],
        purchases=[purchase(3, 9, 2, 2, at=later(3)), purchase(4, 3, 4, 1, "9.00", at=later(3))],
    ), datetime(2024, 1, 18))
    # A replay of earlier rows, and views after the moment.
    layers.apply(3, source.take(
        purchases=[purchase(3, 9, 2, 2, at=later(3)), purchase(6, 7, 9, 1)],
        pageviews=[view(2, "/products/9", "x", datetime(2024, 1, 25)), view(2, "/products/9", "x", AS_OF)],
    ), AS_OF)
    full = stores("full")
    refresh.refresh(full, source.sources(), str(tmp_path / "csv1"), AS_OF)
    assert_equal(store, full)
    layers.apply(3, source.take(), AS_OF)  # done already
    assert_equal(store, full)


@pytest.mark.parametrize("dies_after", [6, 15])
def test_a_load_that_died_goes_on_where_it_was(spark, stores, tmp_path, monkeypatch, dies_after):
    source, store = Source(spark), stores(f"dying{dies_after}")
    first_load(source)
    refresh.refresh(store, source.sources(), str(tmp_path / "csv0"), AS_OF)
    layers = IncrementalLayers(store)
    layers.start(AS_OF)
    delivery = source.take(
        users=[user(3, "bad", DAY + timedelta(days=1))], items=[item(2, "c", at=DAY + timedelta(days=1))],
        purchases=[purchase(1, 4, 3, 1, at=DAY + timedelta(days=1))], pageviews=[view(1, "/products/1")] * 3,
    )
    marks, mark = [], Ledger.mark

    def dying(self, step, rows=None):
        marks.append(step)
        if len(marks) == dies_after:  # the step's work is there, its entry is not
            raise InterruptedError(step)
        return mark(self, step, rows)

    monkeypatch.setattr(Ledger, "mark", dying)
    with pytest.raises(InterruptedError):
        layers.apply(1, delivery, AS_OF)
    monkeypatch.setattr(Ledger, "mark", mark)
    IncrementalLayers(store).apply(1, delivery, AS_OF)
    full = stores(f"whole{dies_after}")
    refresh.refresh(full, source.sources(), str(tmp_path / "csv1"), AS_OF)
    assert_equal(store, full)


def test_loads_build_on_complete_loads(spark, stores):
    layers = IncrementalLayers(stores("none"))
    with pytest.raises(ValueError, match="load 0 is not complete"):
        layers.apply(1, Delivery())


def test_sums_return_to_nothing(spark):
    """A row that comes and goes leaves no key in the state."""
    schema = "channel string, change int"
    there = incremental.channel_sums(spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1)], schema))
    gone = incremental.channel_sums(spark.createDataFrame([("a", -1), ("b", -1), (None, -1)], schema))
    assert rows_of(incremental.merged(there, gone, ["channel"], ("views",))) == [("a", 1)]


def test_facts_are_reduced_before_the_shuffle(spark):
    views = spark.range(1000).select((F.col("id") % 5).alias("user_id"), F.lit("p").alias("page"), F.lit(1).alias("change"),
                                     F.current_timestamp().alias("received_at"))
    plan = incremental.user_days(views)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
