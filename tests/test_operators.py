import random

import pytest
from conftest import final_plan, rows_of
from hypothesis import HealthCheck, given, settings as hypo, strategies as st
from pyspark.sql import functions as F

from tierstone.operators.latest import changes, latest_per_key, upsert
from tierstone.operators.lookup import hot_keys, lookup
from tierstone.operators.once import with_once
from tierstone.operators.rank import top_k


def skewed_facts(spark, rows=3000, hot=7):
    """A third of the rows on one key, some without a key, the rest spread."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(hot)).when(n % 50 == 1, F.lit(None).cast("long")).otherwise(n % 997)
    return spark.range(rows).select(n.alias("n"), key.alias("k"), F.repeat(F.lit("x"), 50).alias("pad"))


def brute_force(facts, dimension):
    names = {}
    for key, name in dimension:
        names.setdefault(key, []).append(name)
    out = []
    for n, k in facts:
        out += [(n, k, name) for name in (names.get(k) if k is not None else None) or [None]]
    return sorted(out, key=str)


@pytest.mark.parametrize("salts", [1, 2, 16])
@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_lookup_equals_brute_force_with_a_hot_key(spark, settings, salts, broadcast):
    settings(spark__sql__autoBroadcastJoinThreshold=broadcast)
    dimension = [(k, f"name-{k}") for k in range(0, 900)] + [(7, "second-7"), (None, "no key")]
    dim = spark.createDataFrame(dimension, "id long, name string")
    facts = skewed_facts(spark)
    got = lookup(facts, dim, "k", "id", {"name": "label"}, salts)
    assert got.columns == ["n", "k", "pad", "label"]
    expected = brute_force([(r["n"], r["k"]) for r in facts.select("n", "k").collect()], dimension)
    assert sorted((tuple(r) for r in got.select("n", "k", "label").collect()), key=str) == expected


def test_salting_spreads_the_hot_key_over_partitions(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__coalescePartitions__enabled="false")
    facts = skewed_facts(spark)
    dim = spark.range(997).select("id", F.col("id").cast("string").alias("name"))

    def holders(salts):
        joined = lookup(facts, dim, "k", "id", {"name": "label"}, salts)
        return joined.where("k = 7").select(F.spark_partition_id()).distinct().count()

    assert holders(1) == 1
    assert holders(16) > 4


def test_hot_key_is_split_by_adaptive_execution(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    )
    facts = skewed_facts(spark, rows=20000).repartition(8)
    dim = spark.range(997).select("id", F.col("id").cast("string").alias("name"))
    joined = lookup(facts, dim, "k", "id", {"name": "label"})
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    assert joined.count() == 20000


def test_lookup_reads_only_what_it_takes(spark, tmp_path):
    wide = spark.range(100).select("id", *(F.lit("x").alias(f"c{i}") for i in range(20)))
    wide.write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    facts = spark.range(10).withColumnRenamed("id", "k")
    plan = final_plan(lookup(facts, dim, "k", "id", {"c3": "label"}))
    assert "ReadSchema: struct<id:bigint,c3:string>" in plan


rows = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 5), st.one_of(st.none(), st.integers(0, 9))),
    max_size=30,
)


@hypo(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(current=rows, incoming=rows)
def test_upsert_equals_brute_force(spark, current, incoming):
    schema = "k long, stamp long, v long"
    # One row per key, as an upsert leaves a table; rows without a key are any number.
    current = list({r[0]: r for r in current if r[0] is not None}.values()) + [r for r in current if r[0] is None]
    best = {}
    for side, part in enumerate((current, incoming)):
        for n, (k, stamp, v) in enumerate(part):
            k = (side, n) if k is None else k
            rank = (stamp, side, v is not None, v)
            if k not in best or rank > best[k][0]:
                best[k] = (rank, (None if isinstance(k, tuple) else k, stamp, v))
    got = upsert(spark.createDataFrame(current, schema), spark.createDataFrame(incoming, schema),
                 ["k"], ["stamp"])
    assert rows_of(got) == sorted((r for _, r in best.values()), key=str)


def test_upsert_scans_the_delivery_once_and_sorts_no_current_rows(spark, settings, tmp_path):
    """Current rows pass by a broadcast of the delivery, which is reduced once."""
    rows = spark.range(1000).selectExpr("id AS k", "id AS stamp", "repeat('x', 50) AS v")
    rows.write.parquet(str(tmp_path / "current"))
    rows.where("k % 100 = 1").write.parquet(str(tmp_path / "delivery"))
    current, delivery = (spark.read.parquet(str(tmp_path / x)) for x in ("current", "delivery"))
    plan = final_plan(upsert(current, delivery, ["k"], ["stamp"]))
    assert "SortMergeJoin" not in plan
    places = [line.split("Location:")[1] for line in plan.splitlines() if "FileScan" in line]
    assert not any(str(tmp_path / "delivery") in x for x in places)  # reduced and kept before
    assert sum(str(tmp_path / "current") in x for x in places) == 2


def test_changes_are_what_an_upsert_changes(spark):
    schema = "k long, stamp long, v string"
    current = spark.createDataFrame([(1, 1, "a"), (2, 5, "b"), (3, 1, "c"), (4, 1, None), (None, 1, "n")], schema)
    incoming = spark.createDataFrame(
        [(1, 2, "A"), (1, 1, "z"), (2, 4, "old"), (3, 1, "c"), (4, 1, "d"), (9, 1, "new"), (None, 1, "n")], schema
    )
    found = rows_of(changes(current, incoming, ["k"], ["stamp"]))
    assert found == sorted(
        [(1, 1, "a", -1), (1, 2, "A", 1), (4, 1, None, -1), (4, 1, "d", 1), (9, 1, "new", 1), (None, 1, "n", 1)],
        key=lambda r: tuple((x is None, str(x)) for x in r),
    )


def test_rows_without_a_key_stay(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 1, "a"), (1, 1, "b"), (1, 2, "c")], "k long, s long, v string")
    assert rows_of(latest_per_key(df, ["k"], ["s"])) == [(1, 2, "c"), (None, 1, "a"), (None, 1, "a")]


def test_hot_keys_of_several_columns(spark):
    facts = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS a", "id % 500 AS b", "id % 20 AS c")
    hot = hot_keys(facts, ["a", "b", "c"], share=0.04)
    found = spark.range(1000).select("id", *(hot[k](F.col("id")).alias(k) for k in ("a", "b", "c")))
    assert {r["id"] for r in found.where("a").collect()} == {7}
    assert found.where("b").count() == 0
    assert {r["id"] for r in found.where("c").collect()} == set(range(20))


def test_latest_reduces_before_the_shuffle(spark):
    history = spark.range(10000).select(
        F.lit(1).alias("k"), F.col("id").alias("stamp"), F.col("id").cast("string").alias("v")
    )
    newest = latest_per_key(history, ["k"], ["stamp"])
    assert [tuple(r) for r in newest.collect()] == [(1, 9999, "9999")]
    plan = final_plan(newest)
    assert "partial_max" in plan and "Window" not in plan


def test_top_k_needs_no_full_sort(spark):
    df = top_k(spark.range(1000).select("id", (F.col("id") % 10).alias("g")), 3, F.desc("g"), F.asc("id"))
    assert [r["id"] for r in df.collect()] == [9, 19, 29]
    assert "TakeOrderedAndProject" in final_plan(df)


def test_with_once_keeps_values_and_stays_in_generated_code(spark):
    df = with_once(spark.range(5), "half", F.when(F.col("id") % 2 == 0, F.col("id") / 2))
    assert rows_of(df) == rows_of(
        spark.range(5).withColumn("half", F.when(F.col("id") % 2 == 0, F.col("id") / 2)))
    plan = final_plan(df.where("half IS NOT NULL AND id > 1"))
    assert "*(1) Generate explode" in plan
