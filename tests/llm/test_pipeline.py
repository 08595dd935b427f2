"""The corpus pipeline, stage by stage against plain versions, and the registered queries."""

import numpy as np
import pytest
from llm_data import TINY, messy, nothing, prose  # noqa: F401
from test_simhash import slow_components, slow_fingerprint

import __spark_entry__ as entry_point
import corpus_pipeline
from tierstone.llm import decontaminate, hash_tree, language, mixing
from tierstone.llm.common import stored, table
from tierstone.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def stages(spark):
    """Documents before the first stage and after each."""
    docs, seen = table(spark, TINY, "documents"), []
    seen.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, TINY), f"test-{name}")
        seen.append(docs)
    return seen


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns_and_order(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "sharding"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    assert ids(stages[-1]) == ids(stages[-2])


def test_language_stage(stages):
    model = language.train(stages[0].where(~language.held_out(stages[0]["doc_id"])))
    expected = sorted(
        r["doc_id"] for r in stages[0].collect() if model.predict(r["text"])[0] != "und" and model.predict(r["text"])[1] >= 0.5
    )
    assert ids(stages[1]) == expected


def test_near_duplicate_stage(stages):
    rows = stages[1].collect()
    numbers, prints = [r["doc_id"] for r in rows], [slow_fingerprint(r["text"]) for r in rows]
    assert ids(stages[2]) == sorted(set(slow_components(numbers, prints)))


def test_decontamination_stage(spark, stages):
    found = decontaminate.contamination(stages[2], table(spark, TINY, "benchmark"))
    bad = {r["doc_id"] for r in found.where("contaminated").collect()}
    assert ids(stages[3]) == [i for i in ids(stages[2]) if i not in bad]


def test_decontamination_keeps_an_index_of_short_rows(spark, tmp_path, monkeypatch):
    """A row had the positions of 4 MB of text."""
    texts = [prose(seed, 300) for seed in range(40)]
    rows = [(n, texts[n % 40]) for n in range(2200)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    spark.createDataFrame([(1, texts[7])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = {}

    def spy(df, label, **options):
        kept[label] = stored(df, label, **options)
        return kept[label]

    monkeypatch.setattr(decontaminate, "stored", spy)
    stay = corpus_pipeline.uncontaminated(spark, docs, str(tmp_path))
    assert sorted(stay.where("doc_id IS NOT NULL").toPandas()["doc_id"]) == [n for n in range(2200) if n % 40 != 7]
    assert stay.count() == 2200 - 55 + 1
    assert kept["index"].selectExpr("max(octet_length(positions))").first()[0] < 512 << 10


def test_mixing_stage(stages):
    """Each document once, and the marginals within 2 % of the targets that can be reached."""
    mixed = stored(mixing.mix(stages[3], once=True), "test-mixed")
    rows = mixed.select("doc_id", "source", "lang", "__topic", "__tokens", "__weight", "__copies", mixing.draw(mixed["doc_id"]).alias("u")).collect()
    assert len(ids(stages[4])) == len(set(ids(stages[4])))
    assert ids(stages[4]) == sorted(r["doc_id"] for r in rows if r["u"] >= 1 - r["__weight"])
    assert max(r["__weight"] for r in rows) == 1.0
    total = mixing.TOKEN_SHARE * sum(r["__tokens"] for r in rows)
    report = {(r["dimension"], r["value"]): r for r in mixing.marginals(mixed).collect()}
    for dimension, column in (("source", "source"), ("lang", "lang"), ("topic", "__topic")):
        has, gets, noise = {}, {}, {}
        for r in rows:
            value, n, p = r[column], r["__tokens"], r["__weight"]
            has[value] = has.get(value, 0) + n
            gets[value] = gets.get(value, 0) + n * p
            noise[value] = noise.get(value, 0) + n * n * p * (1 - p)
        lifted = {v: n ** mixing.POWERS[dimension] for v, n in has.items() if n}
        low, high = 0.0, 10 * total
        for _ in range(200):  # the level at which the cut targets sum to what is wanted
            level = (low + high) / 2
            low, high = (level, high) if sum(min(has[v], level * x) for v, x in lifted.items()) < total else (low, level)
        for v, x in lifted.items():
            target, told = min(has[v], level * x), report[dimension, v]
            assert gets[v] == pytest.approx(target, rel=0.02) == told["reachable"]
            assert told["expected"] == pytest.approx(gets[v])
            assert told["wanted"] == pytest.approx(total * x / sum(lifted.values()))
            assert abs(told["taken"] - gets[v]) <= 4 * noise[v] ** 0.5 + 1e-6


def test_sharding_stage(stages, duck):
    duck.register("stage_docs", stages[4].toPandas())
    names = ", ".join(stages[5].columns)
    expected = duck.sql(f"SELECT {names} FROM ({hash_tree.oracle(corpus_pipeline.SHARDS, 'stage_docs')})").fetchall()
    assert sorted(tuple(r) for r in stages[5].collect()) == sorted(expected)


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(corpus_pipeline.run(spark, TINY).collect()) == sorted(stages[-1].collect())


def test_stages_take_messy_and_empty_tables(spark, messy, nothing):
    for docs in (messy, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, TINY)
            assert name == "sharding" or out.columns == docs.columns
            docs = stored(out, f"messy-{name}")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, TINY)
    columns = sorted(df.columns)
    answer = duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted((tuple(r) for r in df.select(columns).collect()), key=repr) == sorted(answer, key=repr)


def test_every_operator_is_registered():
    names = set(entry_point.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {name.split("_")[0] for name in names} and "pipeline" in names


def test_neighbours_query_recall(spark):
    rows = table(spark, TINY, "embeddings").collect()
    v, vec_ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    found = {}
    for r in QUERIES["op6_neighbours"](spark, TINY).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for i, q in enumerate(vec_ids):
        if q % 20 == 0:
            score = np.where(vec_ids == q, -np.inf, v @ v[i])
            hits += len(found[q] & set(vec_ids[np.lexsort((vec_ids, -score))[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(found)
