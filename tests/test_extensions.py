import glob
import json
from datetime import datetime

import pytest
from conftest import TINY, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.plans import bronze, history, quality
from tierstone.registry.queries import QUERIES
from tierstone.streaming import clicks


# --- past loads


def test_history_reads_the_newest_load_not_after_a_moment(spark, tmp_path):
    loads = history.LoadHistory(spark, str(tmp_path / "h"))
    for load_id, day in ((1, 1), (2, 3)):
        assert loads.add(spark.range(load_id * 10), load_id, datetime(2024, 1, day)) == load_id * 10
    assert loads.as_of(datetime(2024, 1, 1)).count() == 10
    assert loads.as_of(datetime(2024, 1, 2, 23)).count() == 10
    assert loads.as_of(datetime(2024, 1, 3)).count() == 20
    assert loads.version(1).count() == 10
    with pytest.raises(LookupError):
        loads.as_of(datetime(2023, 12, 31))
    assert [(r["load_id"], r["operation"], r["row_count"]) for r in loads.log().orderBy("load_id").collect()] == [
        (1, "overwrite", 10), (2, "overwrite", 20)]


def test_a_load_without_log_entry_is_not_read(spark, tmp_path):
    loads = history.LoadHistory(spark, str(tmp_path / "h"))
    loads.add(spark.range(3), 1, datetime(2024, 1, 1))
    # A load that died after writing its files.
    spark.range(99).write.parquet(str(tmp_path / "h" / "load_id=2"))
    assert loads.as_of(datetime(2024, 6, 1)).count() == 3
    loads.add(spark.range(5), 2, datetime(2024, 1, 2))
    assert loads.as_of(datetime(2024, 6, 1)).count() == 5


def test_a_complete_load_is_not_replaced(spark, tmp_path):
    loads = history.LoadHistory(spark, str(tmp_path / "h"))
    loads.add(spark.range(3), 1, datetime(2024, 1, 1))
    with pytest.raises(ValueError, match="already complete"):
        loads.add(spark.range(4), 1, datetime(2024, 1, 2))
    assert loads.as_of(datetime(2024, 6, 1)).count() == 3


def test_increment_updates_adds_and_keeps(spark, tmp_path):
    schema = "id long, stamp long, v string"
    loads = history.LoadHistory(spark, str(tmp_path / "h"))
    loads.add(spark.createDataFrame([(1, 5, "a"), (2, 5, "b")], schema), 1, datetime(2024, 1, 1))
    changed = spark.createDataFrame([(2, 6, "b2"), (1, 4, "stale"), (3, 1, "new")], schema)
    assert loads.add_increment(changed, ["id"], ["stamp"], 2, datetime(2024, 1, 2)) == 3
    assert rows_of(loads.as_of(datetime(2024, 1, 2))) == [(1, 5, "a"), (2, 6, "b2"), (3, 1, "new")]
    assert rows_of(loads.version(1)) == [(1, 5, "a"), (2, 5, "b")]


# --- changed columns, small files


def test_evolved_columns(spark, tmp_path):
    old, renamed = str(tmp_path / "old"), str(tmp_path / "renamed")
    spark.sql("SELECT 1L AS id, 'gone' AS dropped").write.parquet(old)
    spark.sql("SELECT 2L AS id, 'fox' AS user_agent").write.parquet(renamed)
    columns = {"id": (T.LongType(), []), "ua": (T.StringType(), ["user_agent"]), "later": (T.DateType(), [])}
    df = history.read_evolved(spark, [old, renamed], columns)
    assert df.dtypes == [("id", "bigint"), ("ua", "string"), ("later", "date")]
    assert rows_of(df) == [(1, None, None), (2, "fox", None)]


def test_compaction_keeps_rows_and_reduces_files(spark, tmp_path):
    small, fuller, by_day = (str(tmp_path / n) for n in ("small", "fuller", "by_day"))
    spark.range(1000).withColumn("day", F.col("id") % 3).repartition(20).write.parquet(small)
    stored = spark.read.parquet(small)
    history.compact(stored, fuller)
    history.compact(stored, by_day, "day")
    assert len(glob.glob(f"{small}/*.parquet")) == 20
    assert len(glob.glob(f"{fuller}/*.parquet")) == 1
    assert len(glob.glob(f"{by_day}/*/*.parquet")) == 3
    for path in (fuller, by_day):
        assert rows_of(spark.read.parquet(path).select("id")) == rows_of(stored.select("id"))


# --- gates


def test_gates_count_failures(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, NULL), (2, 'b'), (CAST(NULL AS INT), 'c') AS t(id, name)")
    assert rows_of(quality.gates(df, "t", "id", ["id", "name"])) == [
        ("t", "id_present", 1, False), ("t", "id_unique", 1, False),
        ("t", "name_present", 1, False), ("t", "not_empty", 0, True)]


def test_empty_table_fails_only_the_first_gate(spark):
    empty = spark.range(0)
    result = quality.gates(empty, "t", "id", ["id"])
    assert rows_of(result.where("NOT passed")) == [("t", "not_empty", 1, False)]
    with pytest.raises(quality.GateFailed, match="t: not_empty"):
        quality.enforce(result)
    quality.enforce(quality.gates(spark.range(2), "t", "id", ["id"]))


# --- stream


def test_stream_takes_each_object_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def deliver(number):
        spark.range(3).select(
            F.col("id").alias("user_id"), F.lit("/products/1").alias("url"), F.lit("social").alias("channel"),
            F.lit(1700000000 + number * 86400).alias("received_at"),
        ).coalesce(1).write.mode("append").json(source)

    def run():
        clicks.ingest_available(clicks.click_stream(spark, source, 1), target, checkpoint)
        return clicks.read_ingested(spark, target)

    deliver(0)
    assert run().count() == 3
    assert run().count() == 3
    deliver(1)
    deliver(2)
    stored = run()
    assert stored.count() == 9
    assert stored.schema == bronze.pageviews(spark.read.json(source)).schema
    assert len(glob.glob(f"{target}/part_received_at=*")) == 3


def test_stream_equals_batch(spark):
    batch, stream = QUERIES["json_ingest"](spark, TINY), QUERIES["stream_pageviews"](spark, TINY)
    assert rows_of(batch) == rows_of(stream)


def test_click_lines_hold_whole_seconds(spark, tmp_path):
    from tierstone.sources import shop_tables

    shop_tables.click_log(spark, TINY).limit(5).write.json(str(tmp_path / "j"))
    lines = [json.loads(x) for p in glob.glob(str(tmp_path / "j/*.json")) for x in open(p)]
    assert len(lines) == 5 and all(isinstance(x["received_at"], int) for x in lines)
