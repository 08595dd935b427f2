"""What comes in: objects once each, streams with replays and late rows, audited versions."""

import os
from datetime import datetime, timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tierstone.plans import quality
from tierstone.sinks.ledger import Ledger
from tierstone.sinks.publish import AuditedTable
from tierstone.sinks.store import LayerStore
from tierstone.sources.objects import ClickIngest
from tierstone.streaming.clicks import ClickTable, click_stream

DAY = datetime(2024, 1, 10)


def put(folder, name, *clicks):
    """One object of (user, url, time) lines."""
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        for user, url, at in clicks:
            stamp = "null" if at is None else int(at.timestamp())
            out.write(f'{{"user_id": {user}, "url": "{url}", "channel": "x", "received_at": {stamp}}}\n')


def at(days, seconds=0):
    return DAY + timedelta(days=days, seconds=seconds)


# --- objects -------------------------------------------------------------------------------


def test_each_object_is_read_by_one_load(spark, tmp_path):
    folder, ingest = str(tmp_path / "in"), ClickIngest(spark, str(tmp_path / "out"))
    put(f"{folder}/a", "1.json", (1, "/p/1", at(0)), (2, "/p/2", at(0)))
    put(folder, "2.json", (3, "/p/3", at(1)))
    assert ingest.take(folder, 1).count() == 3
    put(folder, "3.json", (4, "/p/4", at(2)))
    assert [r["user_id"] for r in ingest.take(folder, 2).collect()] == [4]
    assert [r["path"].rsplit("/")[-1] for r in ingest.objects(2).collect()] == ["3.json"]
    assert ingest.take(folder, 3).count() == 0
    # Done loads give what they gave; an object written anew is a new one.
    os.remove(f"{folder}/2.json")
    assert ingest.take(folder, 2).count() == 1
    put(folder, "3.json", (4, "/p/4", at(2)), (5, "/p/5", at(2)))
    assert sorted(r["user_id"] for r in ClickIngest(spark, str(tmp_path / "out")).take(folder, 4).collect()) == [4, 5]
    loads = {(r["load_id"], r["user_id"]) for r in ingest.all_rows().collect()}
    assert loads == {(1, 1), (1, 2), (1, 3), (2, 4), (4, 4), (4, 5)}


def test_a_load_that_died_keeps_its_objects(spark, tmp_path, monkeypatch):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    put(folder, "1.json", (1, "/p/1", at(0)))
    mark = Ledger.mark

    def dying(self, step, rows=None):
        if step.startswith("rows_"):
            raise InterruptedError
        return mark(self, step, rows)

    monkeypatch.setattr(Ledger, "mark", dying)
    with pytest.raises(InterruptedError):
        ClickIngest(spark, root).take(folder, 1)
    monkeypatch.setattr(Ledger, "mark", mark)
    put(folder, "2.json", (2, "/p/2", at(0)))
    ingest = ClickIngest(spark, root)
    assert [r["user_id"] for r in ingest.take(folder, 1).collect()] == [1]
    assert [r["user_id"] for r in ingest.take(folder, 2).collect()] == [2]


# --- streams -------------------------------------------------------------------------------


def test_replays_are_dropped_and_late_clicks_kept_apart(spark, tmp_path):
    folder, check = str(tmp_path / "in"), str(tmp_path / "check")
    table = ClickTable(spark, str(tmp_path / "clicks"), "2 days")
    first = [(1, "/p/1", at(0)), (1, "/p/1", at(0)), (2, "/p/2", at(5))]
    put(folder, "1.json", *first)
    table.ingest_available(click_stream(spark, folder), check)
    assert table.rows().count() == 2 and table.watermark() == at(3)
    # A restart from the checkpoint: a replay, a new click, one too old, one without a time.
    put(folder, "2.json", (2, "/p/2", at(5)), (3, "/p/3", at(3)), (4, "/p/4", at(2)), (1, "/p/1", at(0)), (9, "/p/9", None))
    again = ClickTable(spark, str(tmp_path / "clicks"), "2 days")
    again.ingest_available(click_stream(spark, folder), check)
    assert sorted(r["user_id"] for r in again.rows().collect()) == [1, 2, 3]
    assert sorted(r["user_id"] for r in again.late().collect()) == [1, 4, 9]
    assert {r["step"]: r["rows"] for r in again.entries().collect()} == {"clicks-0": 2, "clicks-1": 1}


def test_a_repeated_batch_changes_nothing(spark, tmp_path, shop, monkeypatch):
    table = ClickTable(spark, str(tmp_path / "clicks"))
    one = shop.pageviews((1, "/a", "x", at(0)), (2, "/b", "x", at(0)))
    two = shop.pageviews((2, "/b", "x", at(0)), (3, "/c", "x", at(1)))
    table.take(one, 0)
    mark = Ledger.mark

    def dying(self, step, rows=None):
        raise InterruptedError

    monkeypatch.setattr(Ledger, "mark", dying)
    with pytest.raises(InterruptedError):  # written, but not entered: nobody sees it
        table.take(two, 1)
    assert table.rows().count() == 2
    monkeypatch.setattr(Ledger, "mark", mark)
    table.take(two, 1)
    table.take(two, 1)
    assert rows_of(table.rows()) == rows_of(one.union(two).distinct())


def test_replays_are_looked_for_in_recent_days_only(spark, tmp_path, shop):
    table = ClickTable(spark, str(tmp_path / "clicks"), "1 day")
    table.take(shop.pageviews(*[(n, "/a", "x", at(n)) for n in range(9)]), 0)
    recent = table._read("taken").where(F.col("day") >= F.to_date(F.lit(at(7).isoformat(" "))))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "(day" in plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]


# --- audited versions ----------------------------------------------------------------------


@pytest.fixture
def audited(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"), "wap_")
    rules = {"quantity": F.col("quantity") > 0, "price": F.col("purchase_price") < 100}
    yield AuditedTable(store, "bronze.purchases", rules)
    spark.sql("DROP DATABASE IF EXISTS wap_bronze CASCADE")


def unique_ids(rows):
    return quality.gates(rows, "bronze.purchases", "id", ["id"])


def test_readers_keep_the_old_rows_until_a_version_passes(audited, shop):
    audited.load(shop.purchases((1, 1, 1, 2, "5.00"), (2, 1, 1, 0, "500.00"), (3, 1, 1, None, "1.00")), 1, unique_ids)
    assert [r["id"] for r in audited.read().collect()] == [1]
    bad = shop.purchases((4, 1, 1, 1, "1.00"), (4, 1, 1, 1, "1.00"), (5, 1, 1, 1, "100.00"))
    with pytest.raises(quality.GateFailed, match="id_unique"):
        audited.load(bad, 2, unique_ids)
    assert [r["id"] for r in audited.read().collect()] == [1]
    # No row is lost: what failed is in its version, what broke a rule in the quarantine.
    assert audited.version(2).count() == 3
    found = {(r["version"], r["id"], r["rejected_by"]) for r in audited.quarantine().collect()}
    assert found == {(1, 2, "quantity"), (1, 3, "quantity"), (2, 5, "price")}
    # The repaired version takes the failed one's place; an earlier one can be shown again.
    audited.load(shop.purchases((4, 1, 1, 1, "1.00"), (6, 1, 1, 1, "1.00")), 2, unique_ids)
    assert sorted(r["id"] for r in audited.read().collect()) == [4, 6]
    audited.publish(1)
    assert [r["id"] for r in audited.read().collect()] == [1]
    with pytest.raises(ValueError, match="published already"):
        audited.load(bad, 1, unique_ids)


def test_too_many_rejected_rows_stop_a_version(audited, shop):
    rows = shop.purchases((1, 1, 1, 1, "1.00"), (2, 1, 1, -1, "1.00"), (3, 1, 1, 1, "1.00"))
    with pytest.raises(quality.GateFailed, match="rejected_share"):
        audited.load(rows, 1, unique_ids, at_most_rejected=0.2)
    audited.load(rows, 1, unique_ids, at_most_rejected=0.4)
    assert audited.read().count() == 2


def test_a_version_of_rejected_rows_only(audited, shop):
    audited.load(shop.purchases((2, 1, 1, -1, "1.00")), 1, lambda rows: quality.gates(rows, "x").where("failures < 0"))
    assert audited.read().count() == 0 and audited.read().schema == audited.contract.schema
