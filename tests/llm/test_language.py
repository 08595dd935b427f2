import numpy as np
import pytest
from llm_data import TINY, messy, nothing, prose  # noqa: F401

from tierstone.llm import language
from tierstone.llm.common import table


def test_held_out_rows_are_told_right(spark):
    docs = table(spark, TINY, "documents")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 20
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) >= 0.95


def test_held_out_rows_teach_nothing(spark):
    """Languages of held-out rows may be anything without changing an answer."""
    docs = table(spark, TINY, "documents")
    other = docs.selectExpr(
        "doc_id", "text", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 'xx' ELSE lang END AS lang"
    )
    key = lambda r: r["doc_id"]
    assert sorted(language.identify(docs).collect(), key=key) == sorted(language.identify(other).collect(), key=key)


def test_messy_rows(messy):
    rows = language.identify(messy).collect()
    assert len(rows) == messy.count()
    assert all(0.0 <= r["score"] <= 1.0 for r in rows)
    told = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert [told[k] for k in (1, 2, 3, -3)] == ["und"] * 4
    assert told[4] == "en"
    kept = language.accepted(messy)
    assert kept.columns == messy.columns
    assert {1, 2, 3, -3}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_no_rows_and_no_languages(spark, messy, nothing):
    assert language.identify(nothing).count() == 0
    unlabelled = messy.withColumn("lang", messy["lang"].substr(9, 1)).replace("", None, ["lang"])
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}


def test_grams_are_of_the_whole_text():
    found, counts = language.gram_counts("ab")
    # " ", "a", "b", " " and their pairs and triples.
    assert counts.sum() == 4 + 3 + 2 and len(found) <= 8


def test_l1_keeps_weights_sparse(spark):
    docs = table(spark, TINY, "documents")
    model = language.train(docs)
    assert 0 < np.count_nonzero(model.weights) < 0.5 * model.weights.size
    assert model.temperature > 0 and model.languages == ["de", "en", "es", "fr"]
    assert model.predict("the of and is to")[1] == pytest.approx(1.0, abs=0.6)


def test_copies_neither_hide_a_language_nor_swell_the_sample(spark, monkeypatch):
    few = [prose(300 + i, 30).upper().translate(str.maketrans("AEIOU", "ÀÉÎÖÜ")) for i in range(3)]
    rows = [(few[i % 3], "xx") for i in range(1800)] + [(prose(400 + i, 30), "yy") for i in range(200)]
    rows += [(prose(400, 30), "yy")] * 500
    seen, examples = [], language._examples
    monkeypatch.setattr(language, "_examples", lambda *given: seen.append(examples(*given)) or seen[-1])
    model = language.train(spark.createDataFrame(rows, "text string, lang string").repartition(4), sample=20)
    assert [sum(truth == k for _, _, truth in seen[0]) for k in (0, 1)] == [3, 20]
    assert [model.predict(t)[0] for t in few] == ["xx"] * 3 and model.predict(prose(900, 30))[0] == "yy"
