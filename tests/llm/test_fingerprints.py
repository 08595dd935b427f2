"""One-permutation MinHash against plain Python, sets of shingles and SQL."""

import hashlib
import re
import zlib

import pytest
from llm_data import SCHEMA, TINY, doc, messy, nothing, prose  # noqa: F401
from pyspark.sql import functions as F

from tierstone.llm import fingerprints, queries
from tierstone.llm.fingerprints import BINS, PRIME, _constant, _order


def shingles(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_print(text):
    """The fingerprint, bin by bin."""
    bins = {}
    for s in shingles(text):
        h = sum(zlib.crc32(w.encode()) * _constant("word", k) for k, w in enumerate(s.split(" "))) % PRIME
        bins[h >> 24] = min(h, bins.get(h >> 24, h))
    if not bins:
        return "00" * BINS
    found = ""
    for b in range(BINS):
        v = bins[b] if b in bins else bins[min(bins, key=lambda o: _order(b, o))]
        found += f"{(v * _constant('factor', b) + _constant('offset', b)) % PRIME % 256:02x}"
    return found


def plain_likeness(one, other):
    equal = sum(one[i : i + 2] == other[i : i + 2] for i in range(0, 2 * BINS, 2))
    return max(0.0, (equal / BINS - 1 / 256) / (1 - 1 / 256))


def plainly(rows):
    """The contract's rows, one document after the other."""
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    docs = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, md5(x[1])))
    found = []
    for k, (doc_id, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        moved = len(text) // 4
        edited = text[: len(text) - moved] + after[:moved]
        prints = plain_print(text), plain_print(edited)
        near = plain_likeness(*prints), plain_likeness(prints[0], plain_print(after))
        found.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *prints, *near))
    return sorted(found, key=repr)


def ours(df):
    return sorted((tuple(r) for r in fingerprints.fingerprints(df).collect()), key=repr)


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_equals_plain_version(spark, messy):
    assert ours(messy) == plainly(pairs(messy))


def test_hot_rows_and_ids(spark, monkeypatch):
    """A third of the rows are one row, a third share an id; portions are small."""
    monkeypatch.setattr(fingerprints, "COPIES_AT_ONCE", 7)
    rows = [doc(5, prose(1, 30))] * 40 + [doc(6, prose(i, 12)) for i in range(40)]
    rows += [doc(i, prose(i, 3 + i)) for i in range(100, 140)] + [doc(None, "x y z")] * 3
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert ours(df) == plainly(pairs(df))
    monkeypatch.setattr(fingerprints, "HOT_SHARE", 2.0)  # nothing is hot
    assert ours(df) == plainly(pairs(df))


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_cuts_change_nothing(spark, monkeypatch, blocks):
    monkeypatch.setattr(fingerprints, "MOST_BLOCKS", blocks)
    df = spark.createDataFrame([doc(i * 7 % 31 - 9, prose(i, 20 + i)) for i in range(31)], SCHEMA)
    assert ours(df) == plainly(pairs(df))


def test_single_and_no_document(spark, nothing):
    one = spark.createDataFrame([doc(3, prose(3, 40))], SCHEMA)
    assert ours(one) == plainly(pairs(one))
    assert ours(one)[0][-1] == 1.0
    assert ours(nothing) == []


def test_likeness_estimates_shared_shingles(spark):
    """Texts that share a known part: the mean error of the estimates is small."""
    texts = []
    for i in range(60):
        words = prose(1000 + i, 400, 100_000).split()
        cut = 40 + 6 * i
        texts.append((i, " ".join(words), " ".join(words[:cut] + prose(2000 + i, 400 - cut, 100_000).split())))
    df = spark.createDataFrame(texts, "i int, a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "fa"), "b", "fb")
    found = df.select("i", fingerprints.likeness(F.col("fa"), F.col("fb"))).collect()
    errors = []
    for i, near in found:
        a, b = shingles(texts[i][1]), shingles(texts[i][2])
        errors.append(near - len(a & b) / len(a | b))
    assert max(map(abs, errors)) < 0.15 and abs(sum(errors) / len(errors)) < 0.02


def test_packing_is_undone(spark):
    df = fingerprints.with_fingerprint(spark.createDataFrame([("",), (prose(1, 9),), (prose(2, 900),)], "a string"), "a", "f")
    packed = fingerprints.packed(F.col("f"))
    found = df.select("a", "f", packed.alias("p"), fingerprints.unpacked(packed).alias("u")).collect()
    for row in found:
        assert row["p"] == plain_print(row["a"]) and row["u"] == row["f"]


def test_short_and_unrelated_texts_are_not_alike(spark):
    rows = spark.createDataFrame([(f"a{i} b{i}", f"c{i}") for i in range(300)], "a string, b string")
    rows = fingerprints.with_fingerprint(fingerprints.with_fingerprint(rows, "a", "fa"), "b", "fb")
    assert rows.agg(F.max(fingerprints.likeness(F.col("fa"), F.col("fb")))).first()[0] < 0.06


def test_query_equals_sql(spark, duck):
    df = queries.QUERIES["op13_minhash"](spark, TINY)
    answer = duck.sql(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLES['op13_minhash']})").fetchall()
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(answer, key=repr) != []


def test_runs_in_the_jvm_without_a_lone_window(spark, messy):
    plan = fingerprints.fingerprints(messy)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan and "Cartesian" not in plan
