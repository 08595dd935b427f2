import json

import pytest
from conftest import rows_of

from tierstone import scratch
from tierstone.plans import bronze
from tierstone.session import RUNTIME_SETTINGS, shuffle_width
from tierstone.sources import jdbc, ndjson

DB = jdbc.Database("jdbc:postgresql://db/shop", "org.postgresql.Driver", "reader", "secret")


class FakeReader:
    """Stands in for spark.read: records options, answers the bounds query."""

    def __init__(self, bounds):
        self.bounds, self.loads, self.current = bounds, [], {}

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        self.current = {}
        return self

    def options(self, **given):
        self.current.update(given)
        return self

    def load(self):
        self.loads.append(dict(self.current))
        return self

    def first(self):
        return self.bounds


def test_table_is_read_in_key_ranges():
    fake = FakeReader((1, 1000))
    jdbc.read_table(fake, DB, "purchases", partitions=8)
    bounds, table = fake.loads
    assert bounds["query"] == "SELECT MIN(id) AS low, MAX(id) AS high FROM purchases"
    assert "dbtable" not in bounds
    assert "query" not in table and table["dbtable"] == "purchases"
    assert (table["partitionColumn"], table["lowerBound"], table["upperBound"], table["numPartitions"]) == (
        "id", "1", "1000", "8")
    assert table["driver"] == "org.postgresql.Driver" and table["fetchsize"] == "10000"


def test_empty_table_and_single_partition_read_in_one_piece():
    fake = FakeReader((None, None))
    jdbc.read_table(fake, DB, "items")
    assert "partitionColumn" not in fake.loads[-1]
    fake = FakeReader((1, 5))
    jdbc.read_table(fake, DB, "items", partitions=1)
    assert len(fake.loads) == 1


def test_times_without_zone_are_not_shifted():
    assert DB.options()["preferTimestampNTZ"] == "true"


def test_password_is_not_shown():
    assert "secret" not in repr(DB)


def write_lines(path, *objects):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(o if isinstance(o, str) else json.dumps(o) for o in objects))


def test_clicks_from_many_objects(spark, tmp_path):
    click = {"user_id": 1, "url": "/products/2", "channel": "social", "received_at": 1700000000}
    write_lines(tmp_path / "log" / "batch_0.json", click, {**click, "user_id": 2, "extra": [1]})
    write_lines(tmp_path / "log" / "batch_1.json", {"user_id": 3}, "not json")
    views = bronze.pageviews(ndjson.read_clicks(spark, str(tmp_path / "log")))
    assert [r[0] for r in rows_of(views)] == [1, 2, 3, None]
    assert views.where("received_at = timestamp'2023-11-14 22:13:20'").count() == 2


@pytest.mark.parametrize("content", [None, ""])
def test_empty_click_source_is_refused(spark, tmp_path, content):
    folder = tmp_path / "log"
    folder.mkdir()
    if content is not None:
        (folder / "batch_0.json").write_text(content)
    with pytest.raises(ndjson.EmptySource):
        ndjson.read_clicks(spark, str(folder))


def test_session_settings_are_applied(spark):
    for key, value in RUNTIME_SETTINGS.items():
        assert spark.conf.get(key) == value


def test_shuffle_width_follows_data_and_cores():
    assert shuffle_width(0, 8) == 16
    assert shuffle_width(10 * 2**40, 1000) == 81920


def test_scratch_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch.new_folder(spark, "x"), scratch.new_folder(spark, "x")
    assert one != two and one.startswith(root + "/")


class ClusterConf:
    def __init__(self, **values):
        self.values, self.conf = values, self

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_root(ClusterConf(**{"spark.master": "yarn"}))
    named = ClusterConf(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/"})
    assert scratch.shared_root(named) == "hdfs:///shared"
