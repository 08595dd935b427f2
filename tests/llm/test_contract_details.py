"""Details of contracts that whole-table tests do not reach."""

import random

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from tierstone.llm import language, neighbours, token_files


@pytest.mark.parametrize("text, letters", [("½ ² ③", False), ("²", False), ("Ⅷ ٣ _", False), ("½a", True), ("ª", True), ("語", True)])
def test_letters_are_letters(text, letters):
    model = language.Model(["en", "de"], np.ones(language.FEATURES), np.zeros((language.FEATURES, 2)), np.zeros(2))
    assert (model.predict(text)[0] == "und") is not letters


@pytest.mark.parametrize("block", [64, 16_384])
def test_equal_products_go_to_the_smaller_id(spark, monkeypatch, block):
    """400 rows of 40 different vectors: products of equal vectors are equal in every block."""
    monkeypatch.setattr(neighbours, "DATA_BLOCK", block)
    rng = random.Random(3)
    vectors = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(40)]
    rows = [(i, vectors[rng.randrange(40)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = neighbours.nearest(df, F.col("id") % 20 == 0)

    def product(a, b):
        total = 0.0
        for x, y in zip(a, b):
            total += x * y
        return total

    wanted = []
    for i, v in rows[::20]:
        near = sorted((-product(w, v), j) for j, w in rows if j != i)[:20]
        wanted += [(i, n + 1, j, -p) for n, (p, j) in enumerate(near)]
    assert sorted(tuple(r) for r in found.collect()) == wanted


def test_marks_after_words_are_encoded_apart():
    """Stretches with every kind of mark against the whole text."""
    encode = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert encode.words is not None
    marks = [".", ",", "...", "$$$", "%%%", "***", "!?", ".'", "'.", "'s", "'s.", "_", "__.", "-", "—", "»", "²", "½.", "9.", "a.b."]
    words = ["word", "Größe", "İstanbul", "x9", "9x", "naïve", "ÉTÉ", "don't", "l'été", "日本", "e\u0301t", "ª", "a_b"]
    for word in words:
        for mark in marks:
            text = f"{word}{mark} {mark}{word} {word.upper()}{mark}{mark}"
            plain = encode.tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(encode(text), encode.kind).tolist() == plain, text


def test_shared_folders_under_spark_schemes_open():
    assert token_files.arrow_uri("s3a://lake/x") == "s3://lake/x"
    assert token_files.arrow_uri("file:///tmp/x") == "file:///tmp/x" and token_files.arrow_uri("/tmp/x") == "/tmp/x"


def test_files_are_read_back_by_many_tasks(spark):
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    manifest = token_files.write(rows.repartition(8), public_tokenizers.path("word_bpe_49k.json"))
    import pyarrow as pa

    schema = pa.schema([("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    back = token_files.read_files(manifest, token_files.count_and_checksum, "n_tokens long, ids_crc32 long", schema)
    assert back.count() == 300
    assert manifest.count() == back.rdd.getNumPartitions()
