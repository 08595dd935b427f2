import zlib
from collections import Counter

import pytest
from llm_data import messy, nothing  # noqa: F401

from tierstone.llm.hash_tree import Leaf, grow, place, regular_tree, shard_documents
from pyspark.sql import functions as F


def places(spark, tree, rows=6000):
    df = place(spark.range(rows), F.col("id"), tree, "shard")
    return {r["id"]: r["shard"] for r in df.collect()}


def test_growth_moves_rows_only_into_the_new_shard(spark):
    before, after = places(spark, regular_tree(24)), places(spark, grow(regular_tree(24)))
    moved = [k for k in before if before[k] != after[k]]
    assert moved and {after[k] for k in moved} == {24}
    assert len(moved) == pytest.approx(6000 / 25, rel=0.3)


def test_a_changed_weight_moves_rows_within_its_subtrees_only(spark):
    tree = regular_tree(12)
    heavier = [Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 0 else 1.0) for x in tree]
    rack = {x.shard: x.rack for x in tree}
    region = {x.shard: x.region for x in tree}
    before, after = places(spark, tree), places(spark, heavier)
    for k in before:
        a, b = before[k], after[k]
        if region[a] != region[b]:
            assert region[b] == 0
        elif rack[a] != rack[b]:
            assert region[b] == 0 and rack[b] == 0
        elif a != b:
            assert b == 0


def test_shares_follow_weights_and_zero_gets_nothing(spark):
    tree = [Leaf(0, 0, 0, 1.0), Leaf(0, 0, 1, 3.0), Leaf(0, 1, 2, 0.0), Leaf(1, 2, 3, 4.0)]
    counts = Counter(places(spark, tree).values())
    assert counts[2] == 0
    assert [counts[s] / 6000 for s in (0, 1, 3)] == pytest.approx([1 / 8, 3 / 8, 1 / 2], abs=0.03)


def test_messy_rows(spark, messy):
    rows = shard_documents(messy, regular_tree(5)).collect()
    source = messy.collect()
    assert len(rows) == len(source)
    expected = Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in source
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert len({(r["doc_id"], r["shard"]) for r in rows}) == len({r["doc_id"] for r in rows})


def test_no_rows(spark, nothing):
    assert shard_documents(nothing, regular_tree(3)).count() == 0
