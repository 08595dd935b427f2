import re

import pyarrow as pa
import pytest
from llm_data import TINY, messy, nothing, prose  # noqa: F401

from tierstone.llm import decontaminate
from tierstone.llm.common import table


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def slow(doc_text, items):
    w, hit, found = words(doc_text), set(), set()
    for ident, text in items:
        item = words(text)
        for at in range(max(1, len(item) - 12) if item else 0):
            window = item[at : at + 13]
            for start in range(len(w) - len(window) + 1):
                if w[start : start + len(window)] == window:
                    hit.update(range(start, start + len(window)))
                    if ident is not None:
                        found.add(str(ident))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def check(docs, items):
    asked = [tuple(r) for r in items.select("item_id", "text").collect()]
    expected = sorted(((r["doc_id"], *slow(r["text"], asked)) for r in docs.collect()), key=repr)
    found = decontaminate.contamination(docs, items)
    rows = found.select("doc_id", "n_words", "n_hit", "item_ids", "contaminated").collect()
    assert sorted((tuple(r) for r in rows), key=repr) == expected


def test_test_documents(spark):
    check(table(spark, TINY, "documents"), table(spark, TINY, "benchmark"))


@pytest.fixture
def items(spark):
    rows = [
        (1, prose(8, 60)[:200]), (2, "one"), (2, "two words"), (3, None), (4, ""), (None, "don t"),
        (5, prose(7, 30000)[5000:5400]), (6, "no such words at all here"), (6, "one"),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_messy_rows(messy, items):
    check(messy, items)


def test_several_passes_and_small_segments_change_nothing(messy, items):
    whole = decontaminate.search(decontaminate.build_index(messy), items)
    parts = decontaminate.search(decontaminate.build_index(messy, segment_bytes=10), items, pass_words=40)
    key = lambda df: sorted((tuple(r) for r in df.select(whole.columns).collect()), key=repr)
    assert key(parts) == key(whole)


def test_a_window_does_not_cross_documents(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, "b c d")], "item_id long, text string")
    assert [r["n_hit"] for r in decontaminate.contamination(docs, items).collect()] == [0, 0]


def test_empty_tables(messy, nothing, items):
    assert decontaminate.contamination(nothing, items).count() == 0
    clean = decontaminate.contamination(messy, items.where("false"))
    assert clean.where("contaminated OR n_hit > 0").count() == 0
    assert clean.count() == messy.count()


def test_clean_keeps_the_others_whole(messy, items):
    bad = decontaminate.contamination(messy, items).where("contaminated").count()
    kept = decontaminate.clean(messy, items)
    assert kept.columns == messy.columns and bad > 0
    assert kept.count() == messy.count() - bad


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x red big fox y fox"), (2, "red fox"), (3, "fox red")], "doc_id long, text string")
    index = decontaminate.build_index(docs)
    found = decontaminate.proximity(index, ["Red fox", ""], slack=1).collect()
    assert sorted(map(tuple, found)) == [(1, "Red fox", 1, 3), (2, "Red fox", 0, 2)]
    exact = decontaminate.proximity(index, ["red fox"], slack=0).collect()
    assert [tuple(r) for r in exact] == [(2, "red fox", 0, 2)]


def large(spark):
    """5 MB of text in one partition, in documents of 300 words and one of 20,000."""
    texts = [prose(seed, 300) for seed in range(40)]
    rows = [(n, texts[n % 40]) for n in range(2200)] + [(9999, prose(41, 20000)), (None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


def test_rows_and_batches_of_the_index_are_short(spark):
    """A row held 4 MB of text, and a batch 256 rows."""
    docs = large(spark)
    text_bytes = docs.selectExpr("sum(octet_length(text))").first()[0]
    assert text_bytes > decontaminate.SEGMENT_BYTES
    index = decontaminate.build_index(docs)
    decontaminate.search(index, spark.createDataFrame([(1, "one")], "item_id long, text string"))

    def sizes(batches):
        for batch in batches:
            rows = [batch.slice(n, 1).nbytes for n in range(batch.num_rows)]
            yield pa.RecordBatch.from_pydict({"batch": [batch.nbytes], "row": [max(rows)]})

    found = index.mapInArrow(sizes, "batch long, row long").collect()
    assert max(r["row"] for r in found) < 1 << 20
    assert max(r["batch"] for r in found) < 5 << 20


def test_rows_that_make_a_segment_are_searched_as_one(spark):
    docs = large(spark)
    asked = [(1, prose(3, 300)[100:300]), (2, prose(41, 20000)[9000:9300]), (3, prose(5, 300)[-60:] + " " + prose(6, 300)[:60])]
    items = spark.createDataFrame(asked, "item_id long, text string")
    found = decontaminate.contamination(docs, items)
    by_text = {t: slow(t, asked) for t in {r["text"] for r in docs.select("text").distinct().collect()}}
    expected = [(r["doc_id"], *by_text[r["text"]]) for r in docs.select("doc_id", "text").collect()]
    rows = found.select("doc_id", "n_words", "n_hit", "item_ids", "contaminated").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)
    assert {"1", "2"} <= {i for r in rows for i in r["item_ids"]}
